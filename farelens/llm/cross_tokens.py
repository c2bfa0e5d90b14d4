"""Aligns two tokenizers' tokens over the same bytes, in Arrow tables inside tasks.

A is a byte-level BPE file (as ``tokenizers`` reads it), B a SentencePiece model, which itself puts a space
before the text; A gets that space by hand, so both cover the same bytes. Per run of documents (about 1 MB of text):

1. Both token lists are flattened; parent indices tell each token's document. Token lengths are taken from a
   table by id and summed up within each document, which gives every token's end.
2. An Acero full outer hash join on (document, end) meets the ends of both sides. Sorted, its rows are the
   pieces that no token boundary cuts; the next token that ends is the token that holds the piece. One row is
   one A-B link, and rows that both sides fill end a group.
3. ``Table.group_by`` counts the links of each document and, from those, in how many documents a pair of ids
   is linked. Such partial counts are added up per chunk (``chunk_bytes`` of text, bounded) and merged by
   Spark for the whole corpus.
4. The corpus counts of a chunk's pairs return to the chunk, one row a pair, and are joined in Acero with the
   links its documents had in step 3, which are kept in a table meanwhile. No count table is broadcast.

Null and empty texts have no tokens, nor have texts whose tokens' bytes differ from space + text on either
side (the SentencePiece model may normalise): zeros and an empty string. Rows that repeat are documents of
their own and count each. Null ids stay null. Other columns are ignored. Names of special tokens inside a
text are plain text. An empty table gives an empty result. Texts are never cut; one document is aligned by
one task.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import chunks, ship
from farelens.session import stage

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHUNK_BYTES = 8 << 20
END_BITS = 36  # a document's bytes fit; the bits above number the documents of a run

FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
ALIGNED = pa.schema(
    [("chunk", pa.int64()), ("counts", pa.bool_()), ("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in FIGURES]
    + [("groups_sha256", pa.string())]
    + [(name, pa.list_(pa.int32())) for name in ("a", "b", "n")]
)
ALIGNED_SQL = (
    "chunk long, counts boolean, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, n array<int>"
)
RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if visible in Latin-1, else from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


class Side:
    """One tokenizer: its token lists as Arrow, the bytes of each id, and ids as text with either mark behind."""

    def __init__(self, pieces: list[bytes], inside: str, closing: str):
        self.bytes = pa.array(pieces, pa.large_binary())
        self.lengths = pc.binary_length(self.bytes).cast(pa.int64())
        self.written = pa.array([f"{i}{mark}" for i in range(len(pieces)) for mark in (inside, closing)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError


# Fixed value: how byte-level pre-tokenisation splits text.
BYTE_LEVEL_PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """A byte-level BPE file's tokens as merge ranks, if ids alone tell the order of its merges, else None.

    That is so when nothing but byte-level splitting precedes a plain BPE model and its merges yield ids in
    their order after the 256 bytes. Merging the pair of lowest id first is then what the file prescribes.
    """
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and model["type"] == "BPE"
        and not any(model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    alphabet, ids = byte_alphabet(), model["vocab"]
    merged = [pair if isinstance(pair, str) else " ".join(pair) for pair in model["merges"]]
    made = [token for token in ids if token in alphabet] + [pair.replace(" ", "") for pair in merged]
    if not plain or [ids.get(token) for token in made[256:]] != list(range(256, 256 + len(merged))):
        return None
    return {bytes(alphabet[c] for c in token): ids[token] for token in made}


class ByteSide(Side):
    """A byte-level BPE file; ``fast`` merges by rank where the file allows it, with the same ids."""

    def __init__(self, path: str, fast: bool = True):
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = {i: token for token, i in self._model.get_vocab(with_added_tokens=True).items()}

        def spelled(token: str) -> bytes:
            return bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()

        super().__init__([spelled(vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)], ",", "|")
        ranks = merge_ranks(json.loads(self._model.to_str())) if fast else None
        self._by_rank = None
        if ranks:
            import tiktoken

            self._by_rank = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._model = None

    def encode(self, texts):
        spaced = [" " + text for text in texts]
        if self._by_rank is not None:
            return [self._by_rank.encode_ordinary(text) for text in spaced]
        encode = getattr(self._model, "encode_batch_fast", self._model.encode_batch)
        return [found.ids for found in encode(spaced, add_special_tokens=False)]


class PieceSide(Side):
    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)

        def spelled(i: int) -> bytes:
            piece = self._model.id_to_piece(i)
            return bytes([int(piece[3:-1], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

        super().__init__([spelled(i) for i in range(self._model.get_piece_size())], ",", ";")

    def encode(self, texts):
        return self._model.encode(texts, num_threads=1)


_loaded: dict[tuple[str, str, str], tuple[Side, Side]] = {}


def sides(folder: str, byte_file: str, piece_file: str) -> tuple[Side, Side]:
    """Both tokenizers, read once per Python worker."""
    where = (folder, byte_file, piece_file)
    if where not in _loaded:
        _loaded[where] = (ByteSide(f"{folder}/{byte_file}"), PieceSide(f"{folder}/{piece_file}"))
    return _loaded[where]


def _as_lists(lists: list[list[int]]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(ids) for ids in lists], out=offsets[1:])
    flat = array("i")
    for ids in lists:
        flat.fromlist(ids)
    return pa.LargeListArray.from_arrays(offsets, np.array(flat, np.int32))


def _covers(side: Side, tokens: pa.Array, wanted: pa.Array) -> pa.Array:
    """Which documents' token bytes, joined, are the wanted bytes."""
    spelled = pa.LargeListArray.from_arrays(tokens.offsets, side.bytes.take(tokens.flatten()))
    return pc.equal(pc.binary_join(spelled, pa.scalar(b"", spelled.type.value_type)), wanted)


def _ends(side: Side, tokens: pa.Array, name: str) -> pa.Table:
    """The flattened tokens with their document-end key: document number above, bytes up to the token's end below."""
    flat, parent = tokens.flatten(), pc.list_parent_indices(tokens).cast(pa.int64())
    total = pc.cumulative_sum(side.lengths.take(flat))
    starts = pa.concat_arrays([pa.array([0], pa.int64()), total]).take(tokens.offsets.slice(0, len(tokens)))
    key = pc.add(pc.shift_left(parent, END_BITS), pc.subtract(total, starts.take(parent)))
    return pa.table({"key": key, name: flat})


def links(a: pa.Table, b: pa.Table) -> pa.Table:
    """Rows (doc, a, b, closes), in order of place: one for each pair of tokens that overlap."""
    met = a.join(b, "key", join_type="full outer", use_threads=False).sort_by("key")
    met = met.combine_chunks()
    left, right = (met[name].combine_chunks() if met.num_rows else pa.array([], pa.int32()) for name in ("a", "b"))
    key = met["key"].combine_chunks() if met.num_rows else pa.array([], pa.int64())
    return pa.table(
        {
            "doc": pc.shift_right(key, END_BITS),
            "a": pc.fill_null_backward(left),
            "b": pc.fill_null_backward(right),
            "ends_a": left.is_valid(),
            "ends_b": right.is_valid(),
            "closes": pc.and_(left.is_valid(), right.is_valid()),
        }
    )


def _hashes(first: Side, second: Side, a: pa.Array, b: pa.Array, met: pa.Table) -> list[str]:
    """SHA-256 of each document's groups, written as a1,a2|b1;a3|b2."""
    closes = met["closes"].to_numpy()
    closes_a, closes_b = (closes[met[name].to_numpy()] for name in ("ends_a", "ends_b"))
    group_a, group_b = (np.cumsum(c) - c for c in (closes_a, closes_b))
    ends_a, ends_b = (np.flatnonzero(c) + 1 for c in (closes_a, closes_b))  # tokens up to each group's end
    n_a, n_b = len(group_a), len(group_b)
    order = np.empty(n_a + n_b, np.int64)
    order[np.arange(n_a) + np.concatenate([[0], ends_b])[group_a]] = np.arange(n_a)
    order[np.arange(n_b) + (ends_a[group_b] if n_b else 0)] = n_a + np.arange(n_b)
    written = pa.concat_arrays(
        [side.written.take(pa.array(ids.flatten().to_numpy().astype(np.int64) * 2 + marks)) for side, ids, marks in ((first, a, closes_a), (second, b, closes_b))]
    )
    both = pa.LargeListArray.from_arrays(pc.add(a.offsets, b.offsets), written.take(pa.array(order)).cast(pa.large_string()))
    return [hashlib.sha256(groups[:-1].encode()).hexdigest() for groups in pc.binary_join(both, pa.scalar("", pa.large_string())).to_pylist()]


def align_texts(texts: list[str | None], first: Side, second: Side) -> tuple[pa.Table, pa.Table]:
    """Of a run of texts: their figures, one row each, and their links as rows (doc, a, b, n), by document."""
    given = [i for i, text in enumerate(texts) if text]
    encoded = [" " + texts[i] for i in given]
    a, b = (_as_lists(side.encode([texts[i] for i in given])) for side in (first, second))
    wanted = pa.array([text.encode() for text in encoded], pa.large_binary())
    good = pc.and_(_covers(first, a, wanted), _covers(second, b, wanted))
    a, b = a.filter(good), b.filter(good)
    rows = np.array(given, np.int64)[good.to_numpy(zero_copy_only=False)] if given else np.zeros(0, np.int64)
    met = links(_ends(first, a, "a"), _ends(second, b, "b"))
    figures = {name: np.zeros(len(texts), np.int64) for name in FIGURES}
    shas = np.full(len(texts), "", object)
    if len(rows):
        docs = met["doc"].to_numpy()
        figures["n_a"][rows] = pc.list_value_length(a).to_numpy()
        figures["n_b"][rows] = pc.list_value_length(b).to_numpy()
        figures["n_groups"][rows] = np.bincount(docs[met["closes"].to_numpy()], minlength=len(rows))
        figures["n_links"][rows] = np.bincount(docs, minlength=len(rows))
        shas[rows] = _hashes(first, second, a, b, met)
    counted = met.group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("doc")
    held = pa.table(
        {
            "doc": pa.array(rows).take(counted["doc"].combine_chunks()) if len(rows) else pa.array([], pa.int64()),
            "a": counted["a"],
            "b": counted["b"],
            "n": counted["count_all"].cast(pa.int32()),
        }
    )
    return pa.table({**figures, "groups_sha256": pa.array(shas.tolist(), pa.string())}), held


def _listed(held: pa.Table, rows: int) -> dict[str, pa.Array]:
    """The links of ``rows`` documents as lists, one a document."""
    offsets = pa.array(np.searchsorted(held["doc"].to_numpy(), np.arange(rows + 1)).astype(np.int32))
    return {name: pa.ListArray.from_arrays(offsets, held[name].combine_chunks()) for name in ("a", "b", "n")}


def _add_up(partial: list[pa.Table]) -> pa.Table:
    """In how many documents each pair is linked."""
    found = pa.concat_tables(partial).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
    return pa.table({"a": found["a"], "b": found["b"], "n": found["n_sum"].cast(pa.int32())})


def _align(batches: Iterable[pa.RecordBatch], where: tuple[str, str, str], chunk_bytes: int, task: int | None = None) -> Iterator[pa.RecordBatch]:
    """Documents with their links, and after each chunk a row of the chunk's partial counts."""
    from pyspark import TaskContext

    first, second = sides(*where)
    number = (TaskContext.get().partitionId() if task is None else task) << 32
    partial: list[pa.Table] = []
    held_bytes = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal partial, held_bytes, number
        if partial:
            counts = _listed(_one_document(_add_up(partial)), 1)
            blank = {name: pa.nulls(1, ALIGNED.field(name).type) for name in ("doc_id", *FIGURES, "groups_sha256")}
            yield _batch({"chunk": pa.array([number]), "counts": pa.array([True]), **blank, **counts})
        partial, held_bytes, number = [], 0, number + 1

    for batch, data, _ in chunks(batches):
        figures, held = align_texts(batch.column("text").to_pylist(), first, second)
        yield _batch(
            {
                "chunk": pa.array(np.full(batch.num_rows, number)),
                "counts": pa.array(np.zeros(batch.num_rows, bool)),
                "doc_id": batch.column("doc_id"),
                **{name: figures[name].combine_chunks() for name in figures.column_names},
                **_listed(held, batch.num_rows),
            }
        )
        pairs = held.group_by(["a", "b"], use_threads=False).aggregate([([], "count_all")])
        partial.append(pa.table({"a": pairs["a"], "b": pairs["b"], "n": pairs["count_all"].cast(pa.int32())}))
        held_bytes += len(data)
        if len(partial) >= 16:
            partial = [_add_up(partial)]
        if held_bytes >= chunk_bytes:
            yield from flush()
    yield from flush()


def _one_document(counts: pa.Table) -> pa.Table:
    return counts.append_column("doc", pa.array(np.zeros(counts.num_rows, np.int64)))


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[field.name].cast(field.type) for field in ALIGNED], schema=ALIGNED)


def _weigh(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents with the sums over their links; ``counts`` holds each pair's corpus count and rank."""
    rows = docs.num_rows
    lists = {name: docs[name].combine_chunks() for name in ("a", "b", "n")}
    held = pa.table({"doc": pc.list_parent_indices(lists["a"]), **{name: lists[name].flatten() for name in lists}})
    found = held.join(counts.select(["a", "b", "held", "top"]), ["a", "b"], join_type="inner", use_threads=False)
    times = found["n"].to_numpy().astype(np.int64)
    at = found["doc"].to_numpy()
    sums = {"n_best": times * found["top"].to_numpy(), "count_sum": times * found["held"].to_numpy()}
    added = {name: np.zeros(rows, np.int64) for name in sums}
    for name, values in sums.items():
        np.add.at(added[name], at, values)
    return pa.table({"doc_id": docs["doc_id"], **{name: docs[name] for name in FIGURES}, **added, "groups_sha256": docs["groups_sha256"]})


def align(
    docs: DataFrame,
    folder: str = TOKENIZERS,
    byte_file: str = BYTE_BPE,
    piece_file: str = PIECE_BPE,
    chunk_bytes: int = CHUNK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The documents' figures, and the corpus's linked id pairs.

    Figures: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is its A id's most frequent one, ties
    included), count_sum (of its links' counts), groups_sha256. Pairs: a, b, held (documents that hold the pair
    linked), top. ``docs`` has doc_id and text; ``folder`` must be readable by the executors.
    """
    ship(docs.sparkSession)
    where = (folder, byte_file, piece_file)
    rows = stage(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            lambda batches: _align(batches, where, chunk_bytes), ALIGNED_SQL
        ),
        "tokens-aligned",
    )
    listed = rows.where("counts").select("chunk", F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
    partial = listed.select("chunk", "p.a", "p.b", "p.n")
    merged = stage(partial.groupBy("a", "b").agg(F.sum("n").alias("held")), "tokens-pairs")
    best = merged.groupBy("a").agg(F.max("held").alias("best"))
    ranked = merged.join(F.broadcast(best), "a").select("a", "b", "held", (F.col("held") == F.col("best")).alias("top"))  # a row per id of A
    returned = partial.select(F.col("chunk").alias("to_chunk"), "a", "b").join(ranked, ["a", "b"])
    figures = (
        rows.where("not counts")
        .select("chunk", "doc_id", *FIGURES, "groups_sha256", "a", "b", "n")
        .groupBy("chunk")
        .cogroup(returned.groupBy("to_chunk"))
        .applyInArrow(_weigh, RESULT_SQL)
    )
    return figures, ranked
