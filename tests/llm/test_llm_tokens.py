"""Token alignment against plain Python over both tokenizers."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import pytest
from llm_fixtures import AWKWARD, DOCS, frame, words
from pyspark.sql import functions as F

from farelens.llm.cross_tokens import BYTE_BPE, PIECE_BPE, TOKENIZERS, ByteSide, align, byte_alphabet, merge_ranks, sides
from farelens.llm.queries import op11_token_alignment

NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(model, pieces, ids):
    at, out = 0, []
    for i in ids:
        out.append((at, at + len(pieces[i]), i))
        at += len(pieces[i])
    return out


def brute(docs):
    """(doc_id, figures) from all pairs of overlapping ranges, one token at a time."""
    first, second = sides(TOKENIZERS, BYTE_BPE, PIECE_BPE)
    a_bytes, b_bytes = first.bytes.to_pylist(), second.bytes.to_pylist()
    found, held = [], Counter()
    for doc_id, text, *_ in docs:
        a = b = []
        if text:
            (a,), (b,) = first.encode([text]), second.encode([text])
            wanted = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) != wanted or b"".join(b_bytes[i] for i in b) != wanted:
                a = b = []
        left, right = spans(first, a_bytes, a), spans(second, b_bytes, b)
        cuts = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        groups, low = [], 0
        for cut in cuts:
            groups.append(
                "|".join(",".join(str(i) for s, e, i in side if low <= s and e <= cut) for side in (left, right))
            )
            low = cut
        links = [(i, j) for s, e, i in left for t, u, j in right if max(s, t) < min(e, u)]
        held.update(set(links))
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        found.append((doc_id, len(a), len(b), len(cuts), links, sha))
    best = defaultdict(int)
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return Counter(
        (d, n_a, n_b, g, len(ls), sum(held[p] == best[p[0]] for p in ls), sum(held[p] for p in ls), sha)
        for d, n_a, n_b, g, ls, sha in found
    )


TEXTS = [
    "The quick brown fox, 1234567 times!",
    "internationalisation of straße — naïve façade 日本語テキスト 😀😀",
    "<|endoftext|> <s> </s> <unk> <0x41> are plain here",
    " leading and  double   spaces\tand\ttabs\n\nlines \n",
    "a",
    " ",
    "  　odd spaces​",
    "é combining, ﬁ ligature, Ⅷ",
    "x" * 3000,
    "def f(x):\n    return x ** 2  # code",
    "\u0001\u0000 control",
]


@pytest.mark.parametrize("chunk_bytes", [1, 8 << 20])
def test_equals_plain_python(spark, chunk_bytes):
    docs = [(i, text, "en", "a") for i, text in enumerate(TEXTS)] + [(100 + i, words(40, i % 5)) for i in range(15)]
    docs += [(200 + i, TEXTS[0]) for i in range(30)] + [(7, TEXTS[1]), (7, TEXTS[1]), (None, "no id"), (300, None), (301, "")]
    table = frame(spark, docs).repartition(3)
    figures, pairs = align(table, chunk_bytes=chunk_bytes)
    assert Counter(tuple(r) for r in figures.select(*NAMES).collect()) == brute(docs)
    assert pairs.groupBy("a", "b").count().where("count > 1").isEmpty()


def test_query_on_the_given_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs_short = [(d, t) for d, t in docs if len(t or "") < 3000]
    found = {r["doc_id"]: r for r in op11_token_alignment(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for row in brute(docs_short):  # figures that don't depend on the rest of the corpus
        assert tuple(found[row[0]][name] for name in NAMES[:5]) == row[:5] and found[row[0]]["groups_sha256"] == row[7]


def test_awkward_rows_and_clashing_columns(spark):
    docs = frame(spark, AWKWARD).withColumns({name: F.lit(1) for name in ("chunk", "counts", "a", "b", "n", "held", "top")})
    figures, _ = align(docs)
    assert Counter(tuple(r)[:3] for r in figures.select(*NAMES).collect()) == Counter(
        row[:3] for row in brute([d for d in AWKWARD if len(d[1] or "") < 10_000]).elements()
    ) + Counter(tuple(r)[:3] for r in figures.where("doc_id = 7").select(*NAMES).collect())


def test_empty_table(spark):
    figures, pairs = align(spark.createDataFrame([], DOCS))
    assert figures.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert figures.count() == 0 and pairs.count() == 0


def test_byte_alphabet_is_a_bijection():
    table = byte_alphabet()
    assert sorted(table.values()) == list(range(256)) and table["A"] == 65 and table["Ġ"] == 32


def test_merging_by_rank_gives_the_ids_of_the_file():
    fast, plain = (ByteSide(f"{TOKENIZERS}/{BYTE_BPE}", fast=way) for way in (True, False))
    assert fast._by_rank is not None and plain._by_rank is None
    rng = random.Random(5)
    pool = [chr(c) for c in [*range(0x20, 0x250), *range(0x2000, 0x2070), 0x3000, 0x85, 9, 10, 13, 0x4E2D, 0x627, 0x93F, 0x1F600]]
    texts = TEXTS + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    texts += [f"a{chr(c)}b {chr(c)} 1{chr(c)}" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert fast.encode(texts) == plain.encode(texts)


def test_a_file_that_is_not_plain_is_not_merged_by_rank():
    spec = json.load(open(f"{TOKENIZERS}/{BYTE_BPE}"))
    assert merge_ranks(spec)
    assert merge_ranks({**spec, "normalizer": {"type": "Lowercase"}}) is None
    assert merge_ranks({**spec, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}) is None
    turned = {**spec["model"], "merges": spec["model"]["merges"][::-1]}
    assert merge_ranks({**spec, "model": turned}) is None
