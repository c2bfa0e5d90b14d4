import hashlib
import os
import random
import re
import sys

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

sys.path.insert(0, os.path.dirname(__file__))
from llm_fixtures import AWKWARD, frame  # noqa: E402

from farelens.llm import pii  # noqa: E402
from farelens.llm.common import table  # noqa: E402

# The patterns as they are dealt.
DEALT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    out = {}
    for kind, pattern in DEALT.items():
        out[kind] = [f"{kind}:{m.start()}:{m.end()}" for m in re.finditer(pattern, text or "") if passes(kind, m.group())]
    return out


def check(got, rows):
    want = {}
    for i, text, *_ in rows:
        want.setdefault(i, []).append(base(text))
    for r in got:
        spans = want[r.doc_id][0]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in DEALT), r
        listed = [x for k in DEALT for x in spans[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        shown = r.spans.split(",") if r.spans else []
        assert shown[: len(listed)] == listed and len(shown) == len(listed) + r.n_added


TEXTS = [
    "mail a.b@c.de_x@y.org, a@b c@d.e.f. @x.y z@w.x",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0000255 001.02.3.4 1..2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111 1111 1111 1112; 4111  1111",
    "5 4111111111111111 4111111111111111 - 5500005555555559x",
    "+1 (523) 555-7040 +49 30 1234567. +1234 +1 23456789012345678 ++49(0)30-123456 +4 ",
    "Mr. John Smith, phone (030) 555-1234; order 123456789012; SSN 078-05-1120",
    "ünïcode 😀 a@b.co 😀 10.0.0.1",
    "9" * 3000 + "@" + "a." * 500 + "com",
    "\u0001a@b.co\u0002 1.1.1.1\u0001",
]


def test_base_spans(spark):
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = pii.pii_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    check(got, rows)


def test_sample_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = pii.pii_report(docs).collect()
    assert len(got) == len(rows) and sum(r.n_email for r in got) > 5
    check(got, rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1290.@+-() %_😀", max_size=60), min_size=30, max_size=60))
def test_random_texts(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    check(pii.pii_report(frame(spark, rows)).collect(), rows)


def test_added_spans(spark):
    """Labelers agree on numbers and names after a cue and against numbers after 'order' or 'id'."""
    rows = []
    for i in range(60):
        rows.append((4 * i, f"please call (0{i + 30}) 555-{1000 + i * 7} today"))
        rows.append((4 * i + 1, f"see order {i}12345678{i} or token=987654321{i}"))
        rows.append((4 * i + 2, "her name is Mrs. Maria Huber, they say"))
        rows.append((4 * i + 3, "nothing to see"))
    got = {r.doc_id: r for r in pii.pii_report(frame(spark, rows)).collect()}
    assert all(got[4 * i].n_added == 1 and "local:12:" in got[4 * i].spans for i in range(60))
    assert all(got[4 * i + 2].n_added == 1 and "person:12:" in got[4 * i + 2].spans for i in range(60))
    assert not any(got[4 * i + 1].n_added or got[4 * i + 3].n_added for i in range(60))


def test_reliabilities_tell_good_labelers_from_random_ones():
    import random

    rng, counts = random.Random(1), {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = [(1 if truth else -1) * (1 if rng.random() < p else -1) for p in (0.95, 0.9, 0.9, 0.5, 0.5, 0.85)]
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + 1
    share, tables = pii.reliabilities(sorted(counts.items()))
    assert abs(share - 0.4) < 0.05 and tables[0][1, 1] > 0.9 and abs(tables[3][1, 1] - 0.5) < 0.06


def test_empty_table(spark):
    assert pii.pii_report(frame(spark, [])).collect() == []


FIRST = ["Maria", "Klaus", "Juan", "Sophie", "Robert", "Heike", "Luis", "Camille", "Ottokar", "Ximena", "Thorvald", "Briseida"]
LAST = ["Lopez", "Weber", "Moreau", "Miller", "García", "Schäfer", "Dupont", "Baker", "Quintero", "Novak"]
CUES = [
    "please call {} at noon", "contact: {} will help", "my name is {}, she said", "fragen Sie {} im Büro", "der Kunde {} hat bezahlt",
    "el cliente {} llegó ayer", "pregunte por {} en la oficina", "appelez {} demain matin", "le client {} est parti", "we met {} there",
]
OTHER = [
    "The Great River runs far.", "New Haven Times wrote it.", "It was near Baker Street Station then.", "Rain fell. Green Hills shone.",
    "der Alte Bahnhof Platz war leer", "la Plaza Mayor Ciudad es grande", "order 123456789012 came", "nothing here at all",
]


def test_planted_persons_in_four_languages(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(600):
        if i % 2:
            name = f"{rng.choice(FIRST)} {rng.choice(LAST)}"
            cue = rng.choice(CUES)
            at = cue.index("{}")
            rows.append((i, cue.format(name)))
            want[i] = f"person:{at}:{at + len(name)}"
        else:
            rows.append((i, rng.choice(OTHER)))
    got = {r.doc_id: r.spans for r in pii.pii_report(frame(spark, rows)).collect()}
    found = sum(want[i] in got[i].split(",") for i in want)
    wrong = sum("person:" in got[i] for i in range(0, 600, 2))
    assert found >= 0.9 * len(want) and wrong <= 0.1 * 300


def test_the_classifier_sees_more_than_the_votes(spark):
    rows = [(i, f"(Maria Lopez{i % 5}) and call Anna Weber, 4{i} on") for i in range(40)]
    candidates = pii.found_spans(frame(spark, rows)).selectExpr("explode(candidates) c")
    assert candidates.count() > 0
    weights = pii.span_classifier([(("bias", ("left", 1)), 0.9, 10), (("bias", ("left", 4)), 0.1, 10)])
    assert weights["left", 1] > 0 > weights["left", 4]
