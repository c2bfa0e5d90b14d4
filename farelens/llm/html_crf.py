"""Main text of HTML pages by a linear-chain conditional random field over the leaf blocks of the DOM.

A page is cut into leaf blocks: runs of text that no block-level tag interrupts. Each block has features
of its ancestors (tags, words of their class, id and role, hidden state) and of its text (length, share
of text in links, marks, digits, repeated separators). The field labels the sequence main text or not;
its weights are fitted by stochastic gradient of the likelihood on labelled pages and pages are decoded
by Viterbi. The labelled pages are composed here from layout rules (``labelled_pages``): no table of
labelled pages is given, and weights on tags and layout words carry over to any vocabulary.

Scripts, styles, comments, the head and form controls never are text. Character references are decoded,
white space inside a block becomes one space, blocks are trimmed and joined by one line end in page
order; nothing else is dropped or cut. Null and empty pages, and pages without main text, give an empty
text. Broken markup (tags not closed, a page cut short) is read as far as it goes: a head ends at the first
text or tag that can't stand in it, another silent element without an end tag at the next block-level tag.
"""

from __future__ import annotations

import functools
import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import chunks, ship

# Tags that don't interrupt a block, tags that never have content, tags whose content isn't text.
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr "
    # Formulas stand in their sentence.
    "math semantics maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt "
    "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set(
    "script style noscript template svg annotation annotation-xml iframe object canvas head title select textarea button datalist".split()
)
# Tags that may stand in a head, block tags that end another silent element left open, silent elements that nest.
IN_HEAD = set("html head title base link meta style script noscript template".split())
ENDS_SILENT = set(
    "address article aside blockquote body dd details dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav "
    "ol p pre section table td th tr ul".split()
)
NESTED = set("template svg object".split())
CLOSED_BY = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SECTIONS = {f"t:{tag}" for tag in "article aside main nav header footer form section".split()}
CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol "
    "p pre section table ul".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|(?=<)|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SILENT_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)(%s)(?=[\s/>])([^>]*)" % "|".join(sorted(SILENT - {"script", "style", "head"}, reverse=True)),
    re.I | re.S,
)
RAW = re.compile(r"</(script|style)\s*>", re.I)


def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element says about the blocks in it."""
    out = [f"t:{tag}"]
    for name, *values in ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            out += [f"c:{x}" for x in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())]
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.append("hidden")
        elif name == "aria-hidden" and value == "true":
            out.append("hidden")
    return tuple(out)


def _closed(page: str) -> set[int]:
    """Where the silent elements begin that have an end tag of their own."""
    left: dict[str, list[int]] = {}
    out = set()
    for m in SILENT_TAG.finditer(page):
        tag = (m[3] or "").lower()
        if not tag or m[4].rstrip().endswith("/"):
            continue
        if m[2]:
            if left.get(tag):
                out.add(left[tag].pop())
        elif tag in NESTED:
            left.setdefault(tag, []).append(m.start())
        else:
            left[tag] = [m.start()]
    return out


class Place:
    """An open element as the blocks in it see it: what it and its ancestors say, each shared, not copied."""

    __slots__ = ("marks", "own", "near", "above")

    def __init__(self, own: tuple[str, ...], above: Place | None):
        known = above.marks if above else frozenset()
        self.own, self.above = own, above
        self.marks = known if known.issuperset(own) else known.union(own)
        # The nearest element that says what part of the page this is.
        says = own[0] in SECTIONS or any(m[:2] == "c:" for m in own)
        self.near = own if says or not above else above.near


OUTSIDE = Place(("t:",), None)


def leaf_blocks(page: str) -> list[tuple[str, Place, float]]:
    """(text, innermost block-level element, share of the text in links) of every block with text, in order."""
    stack: list[tuple[str, Place]] = []
    blocks, parts, linked = [], [], 0
    in_link = 0
    silent: list[tuple[int, str, bool]] = []  # place in the stack, tag, whether it has an end tag
    closed = _closed(page)

    def flush():
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append((text, stack[-1][1] if stack else OUTSIDE, min(1.0, linked / len(text))))
            parts, linked = [], 0

    def pop_to(n: int):
        nonlocal in_link
        while len(stack) > n:
            tag, _ = stack.pop()
            in_link -= tag == "a"
        while silent and silent[-1][0] >= n:
            silent.pop()

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        text = page[at : m.start() if m else size]
        if silent and silent[-1][1] == "head" and text.strip():
            pop_to(silent[-1][0])
        if text and not silent:
            parts.append(text)
            if in_link:
                linked += len(text.strip())
        if not m:
            break
        at = max(m.end(), m.start() + 1)
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            # An inline tag's end doesn't reach beyond the block it stands in.
            if depth is None or tag in INLINE and any(t not in INLINE for t, _ in stack[depth + 1 :]):
                continue
            if tag not in INLINE:
                flush()
            pop_to(depth)
            continue
        if tag == "br":
            parts.append(" ")
        if tag in ("script", "style"):
            end = RAW.search(page, at)
            while end and end[1].lower() != tag:
                end = RAW.search(page, end.end())
            at = end.end() if end else size
            continue
        while silent and not silent[-1][2] and (tag not in IN_HEAD if silent[-1][1] == "head" else tag in ENDS_SILENT):
            pop_to(silent[-1][0])
        if tag not in INLINE:
            flush()
            ends = CLOSED_BY.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    pop_to(i)
                    break
                if stack[i][0] not in INLINE and stack[i][0] not in ("p", "td", "th", "li", "tr"):
                    break
                if tag in ("li", "td", "th", "tr") and stack[i][0] in ("ul", "ol", "table"):
                    break
        if tag not in VOID and not m[3].rstrip().endswith("/"):
            above = stack[-1][1] if stack else OUTSIDE
            stack.append((tag, above if tag in INLINE else Place(_marks(tag, m[3]), above)))
            if tag in SILENT:
                silent.append((len(stack) - 1, tag, m.start() in closed))
            in_link += tag == "a"
    flush()
    return blocks


def _size(number: float, most: int) -> int:
    return min(int(number).bit_length(), most)


def page_features(blocks: list[tuple[str, Place, float]]) -> list[tuple[str, ...]]:
    """Features of each block: what its ancestors say, its text, its neighbours and the element it shares with them.

    The latter carry over to any layout and vocabulary: how long a block and its neighbours are, how much of
    them are links, how much text the surrounding element holds and which part of the page's text that is.
    """
    words = [text.count(" ") + 1 for text, _, _ in blocks]
    total = sum(words) or 1
    # Words, linked words and blocks of the elements one and two levels around each block.
    held: dict[int, list[float]] = {}
    around = []
    for n, (_, place, linked) in zip(words, blocks, strict=True):
        one = place.above or place
        two = one.above or one
        around.append((one, two))
        for element in {id(one): one, id(two): two}.values():
            sums = held.setdefault(id(element), [0, 0.0, 0])
            sums[0] += n
            sums[1] += n * linked
            sums[2] += 1
    short = [f"{_size(n, 7)}/{int(linked * 3)}" for n, (_, _, linked) in zip(words, blocks, strict=True)]
    largest = max((sums[0] for sums in held.values()), default=0)
    out = []
    for i, (text, place, linked) in enumerate(blocks):
        found = set(place.marks)
        found |= {f"own {f}" for f in place.own}
        found |= {f"near {f}" for f in place.near}
        found.add(f"words {_size(words[i], 7)}")
        found.add(f"linked {int(linked * 3)}")
        if text[-1] in ".!?:;…\"'":
            found.add("sentence end")
        if sum(c.isdigit() for c in text) * 4 > len(text):
            found.add("digits")
        if "|" in text or "·" in text or "»" in text or "©" in text:
            found.add("separator")
        if "©" in text[:12]:
            found.add("rights")
        found.add(f"sentences {_size(text.count('. '), 3)}")
        found.add(f"part {5 * i // len(blocks)}")
        found.add(f"share {_size(64 * words[i] / total, 6)}")
        found.add("before " + (short[i - 1] if i else "none"))
        found.add("after " + (short[i + 1] if i + 1 < len(blocks) else "none"))
        for name, element in zip(("around", "wider"), around[i], strict=True):
            n, links, count = held[id(element)]
            found.add(f"{name} words {_size(n, 11)}")
            found.add(f"{name} mean {_size(n / count, 7)}")
            found.add(f"{name} linked {int(links / n * 4)}")
            found.add(f"{name} share {_size(16 * n / total, 5)}")
            if n == largest:
                found.add(f"{name} largest")
        found.add("always")
        out.append(tuple(sorted(found)))
    return out


class Field:
    """Two labels, 0 for the rest and 1 for main text."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.w = np.zeros((0, 2))
        self.pair = np.zeros((2, 2))
        self.first = np.zeros(2)

    def emissions(self, rows: list[tuple[str, ...]]) -> np.ndarray:
        get, w = self.index.get, self.w
        out = np.zeros((len(rows), 2))
        for i, row in enumerate(rows):
            known = [k for k in map(get, row) if k is not None]
            out[i] = w[known].sum(0)
        return out

    def fit(self, pages: list[tuple[list[tuple[str, ...]], list[int]]], epochs: int = 6, rate: float = 0.3) -> Field:
        for rows, _ in pages:
            for row in rows:
                for f in row:
                    self.index.setdefault(f, len(self.index))
        self.w = np.zeros((len(self.index), 2))
        rng = random.Random(29)
        seen = np.full_like(self.w, 1e-3)
        for epoch in range(epochs):
            for rows, y in rng.sample(pages, len(pages)):
                if not rows:
                    continue
                e, n = self.emissions(rows), len(rows)
                forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
                forward[0] = e[0] + self.first
                for i in range(1, n):
                    forward[i] = e[i] + np.logaddexp(*(forward[i - 1][:, None] + self.pair))
                for i in range(n - 2, -1, -1):
                    backward[i] = np.logaddexp(*(self.pair + e[i + 1] + backward[i + 1]).T)
                total = np.logaddexp(*forward[-1])
                node = np.exp(forward + backward - total)
                gold = np.eye(2)[y]
                for row, g in zip(rows, gold - node, strict=True):
                    ids = [self.index[f] for f in row]
                    seen[ids] += g**2
                    self.w[ids] += rate * (g - 1e-4 * self.w[ids]) / np.sqrt(seen[ids])
                step = rate / (2 + epoch)
                self.first += step * (gold[0] - node[0])
                for i in range(1, n):
                    joint = np.exp(forward[i - 1][:, None] + self.pair + e[i] + backward[i] - total)
                    self.pair += step * 0.1 * (gold[i - 1][:, None] * gold[i] - joint)
        return self

    def decode(self, rows: list[tuple[str, ...]]) -> list[int]:
        """The best label sequence (Viterbi); of equal ones, label 0 earlier."""
        if not rows:
            return []
        e = self.emissions(rows).tolist()
        (p00, p01), (p10, p11) = self.pair.tolist()
        s0, s1 = e[0][0] + self.first[0], e[0][1] + self.first[1]
        back = []
        for e0, e1 in e[1:]:
            from0, from1 = s1 + p10 > s0 + p00, s1 + p11 > s0 + p01
            back.append((from0, from1))
            s0, s1 = e0 + (s1 + p10 if from0 else s0 + p00), e1 + (s1 + p11 if from1 else s0 + p01)
        label = int(s1 > s0)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


# Layout words of the composed pages: (tag, class) of elements around text that isn't the article.
REST = {
    "nav": [("nav", ""), ("ul", "menu"), ("div", "nav"), ("div", "navbar"), ("div", "breadcrumb"), ("div", "topbar navigation"),
            ("ul", "pagination"), ("div", "toc")],
    "head": [("header", ""), ("div", "header"), ("div", "masthead"), ("div", "banner"), ("header", "site header")],
    "foot": [("footer", ""), ("div", "footer"), ("div", "copyright"), ("footer", "site footer")],
    "side": [("aside", ""), ("div", "sidebar"), ("aside", "related"), ("div", "widget"), ("section", "recommended"), ("div", "links")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "promo"), ("div", "sponsored"), ("ins", "advertisement"),
           ("section", "promotion sponsor")],
    "notice": [("div", "cookie"), ("div", "cookie notice"), ("div", "notice"), ("div", "consent"), ("div", "alert"), ("div", "popup modal"),
               ("div", "newsletter subscribe"), ("div", "gdpr")],
    "form": [("form", ""), ("form", "search"), ("form", "login signup"), ("div", "search")],
    "talk": [("section", "comments"), ("div", "comment"), ("ol", "comment list"), ("div", "discussion replies"), ("div", "disqus thread")],
    "share": [("div", "share"), ("div", "social"), ("ul", "tags"), ("div", "author meta"), ("div", "byline")],
}
MAIN = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article body"), ("div", "post content"),
        ("section", "entry"), ("div", "main"), ("div", "story text")]


def labelled_pages(n: int = 1800, seed: int = 41) -> list[tuple[str, list[int]]]:
    """Pages composed by rule, and for each block of ``leaf_blocks`` whether it is main text.

    Of five pages three name their elements by the words above, one by words that mean nothing, one not at all;
    of the latter half use no sectioning tags, and some have tables as layout or no element around the main
    text, so that what the layout says is only one sign among those of the text itself.
    """
    rng = random.Random(seed)
    out = []

    def words(low, high):
        return " ".join("".join(rng.choice("aeioulnrstdmkp") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))

    for _ in range(n):
        labels: list[int] = []
        naming = rng.choice(["telling", "telling", "telling", "empty", "none"])
        telling = naming == "telling"
        plain = naming != "telling" and rng.random() < 0.5  # no sectioning tags
        cells = plain and rng.random() < 0.25

        def opened(tag, names, plain=plain, naming=naming):
            if plain and f"t:{tag}" in SECTIONS:
                tag = "div"
            if naming == "none" or not names and naming == "telling":
                return f"<{tag}>", tag
            if naming == "empty":
                names = "".join(rng.choice("bcdfghjkqvwxyz") for _ in range(rng.randint(3, 8)))
            return f'<{tag} {rng.choice(["class", "class", "id"])}="{names.replace(" ", rng.choice(["-", " "]))}">', tag

        def text(label, low, high, end=""):
            labels.append(label)
            return words(low, high) + end

        def rest(kind, naming=naming):
            tag, names = rng.choice(REST[kind])
            start, tag = opened(tag, names)
            # Where nothing is named, only what shows in the text tells such blocks apart: they are short or links.
            most = 40 if naming == "telling" else {"talk": 40, "notice": 20, "ad": 14}.get(kind, 10)
            inner = []
            listed = tag in ("ul", "ol") or kind in ("nav", "side", "share") and rng.random() < (0.4 if naming == "telling" else 0.7)
            for _ in range(rng.choice([1, 1, 2, 4, 6] if naming == "telling" else [3, 5, 8] if listed else [1, 1, 2, 3])):
                if kind in ("nav", "side", "share") and (rng.random() < 0.7 or naming != "telling") or listed:
                    item = f"<a href='/x'>{text(0, 1, 4)}</a>"
                    inner.append(f"<li>{item}</li>" if listed or rng.random() < 0.3 else f"<p>{item}</p>" if rng.random() < 0.5 else f"<div>{item}</div>")
                elif kind == "form":
                    inner.append(f"<p><label>{text(0, 1, 6)}</label><input></p><button>{words(1, 2)}</button>")
                else:
                    sign = rng.choice(["", "&copy; ", "", "&middot; "]) if kind == "foot" else ""
                    inner.append(f"<{(t := rng.choice(['p', 'div', 'h3', 'p', 'span']))}>{sign}{text(0, 1, most, rng.choice(['.', '']))}</{t}>"
                                 if rng.random() < 0.7 or len(inner) else f"<p>{sign}{text(0, 2, min(most, 30), '.')}")
                    if "<span>" in inner[-1]:
                        inner[-1] = f"<div>{inner[-1]}</div>"
            if listed and tag not in ("ul", "ol"):
                inner = ["<ul>", *inner, "</ul>"]
            return start + "".join(inner) + f"</{tag}>"

        def main_block():
            kind = rng.random()
            if kind < 0.08:
                return f"<ul><li>{text(1, 1, 20)}</li><li>{text(1, 1, 20)}</li></ul>"
            if kind < 0.14:
                return f"<blockquote>{text(1, 1, 40, '.')}</blockquote>"
            if kind < 0.18:
                return f"<pre>{text(1, 1, 30)}</pre>"
            if kind < 0.22:
                return f"<table><tr><td>{text(1, 1, 4)}</td><td>{text(1, 1, 4)}</td></tr></table>"
            if kind < 0.30:
                return f"<h2>{text(1, 1, 8)}</h2>"
            if kind < 0.36 and telling:
                return f"<p><a href='/y'>{text(1, 1, 12)}</a></p>"
            if kind < 0.36:
                return f"<p>{text(1, 3, 30)} <a href='/y'>{words(1, 6)}</a>.</p>"
            if kind < 0.42:
                return f"<div>{text(1, 1, 60, '.')}</div>"
            sign = rng.choice(["", "", "", " | ", "&amp;&amp; "])
            return f"<p>{sign}{text(1, 1, rng.choice([2, 10, 80]), rng.choice(['.', '.', '', '!!', '$$$']))}</p>"

        body = [rest(k) for k in rng.sample(["head", "nav", "notice", "ad", "form"], rng.randint(1 if telling else 0, 4))]
        tag, names = rng.choice(MAIN) if rng.random() < 0.6 else MAIN[0]
        inside = [f"<h1>{text(1, 1, 10)}</h1>" if rng.random() < 0.8 else ""]
        if not telling:  # at least one paragraph that reads like one
            inside.append(f"<p>{text(1, 20, 90, '.')}</p>")
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            inside.append(main_block())
            if rng.random() < 0.15:
                inside.append(rest(rng.choice(["ad", "share", "side", "notice", "form"] if telling else ["share", "form"])))
        if rng.random() < 0.15 and telling:
            inside.append(rest("talk"))
        shape = rng.random()
        start, tag = opened(tag, names)
        if not telling and shape < 0.25:  # nothing around the main text
            body.append("".join(inside))
        elif cells:
            start, _ = opened("td", names)
            body = [f"<table><tr><td>{''.join(body)}</td>{start}{''.join(inside)}</td></tr></table>"]
        else:
            whole = start + "".join(inside) + f"</{tag}>"
            for _ in range(rng.choice([0, 0, 1, 2])):
                outer, of = opened(rng.choice(["div", "div", "main"]), rng.choice(["page wrapper", "wrap", "row"]))
                whole = f"{outer}{whole}</{of}>"
            body.append(whole)
        body += [rest(k) for k in rng.sample(["talk", "side", "ad", "share", "nav"] if telling else ["side", "ad", "share", "nav"], rng.randint(0, 3))]
        if rng.random() < (0.8 if telling else 0.6):
            body.append(rest("foot"))
        page = f"<!DOCTYPE html><html><head><title>{words(1, 5)}</title><style>p{{}}</style></head><body>{''.join(body)}</body></html>"
        if len(leaf_blocks(page)) == len(labels):
            out.append((page, labels))
    return out


@functools.lru_cache(maxsize=2)
def trained(n: int = 1800, seed: int = 41) -> Field:
    return Field().fit([(page_features(leaf_blocks(p)), y) for p, y in labelled_pages(n, seed)])


def main_text(field: Field, page: str) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b[0] for b, y in zip(blocks, field.decode(page_features(blocks)), strict=True) if y)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars. ``pages`` has page_id, url, html."""
    ship(pages.sparkSession)
    field = pages.sparkSession.sparkContext.broadcast(trained())
    kind = pages.schema["page_id"].dataType.simpleString()

    def extract(batches):
        fitted = field.value
        for batch, _, _ in chunks(batches, "html"):
            texts = [main_text(fitted, p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    rows = pages.select("page_id", F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    return rows.mapInArrow(extract, f"page_id {kind}, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long")
    )
