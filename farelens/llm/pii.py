"""Finds personal data: fixed patterns, and spans added by weak supervision. DataFrame operations only.

The base patterns (email, ip, card, phone) are matched leftmost without overlap, each kind by itself;
matches that fail their check are dropped without another try. They always stay.

Other spans are candidates of the added kinds: ``local`` (telephone numbers without a plus sign),
``account`` (9 to 19 digits), ``person`` (a title and capitalised words, or two to three capitalised words),
``ssn`` (3-2-4 digits). Labelers vote +1, -1 or 0 on every candidate: the shape (regular expressions),
gazetteers (first names, words of places and firms, dialling and issuer prefixes), the words and signs
before it, and whether it begins a sentence. Votes are counted by their pattern over all documents;
expectation-maximisation on those counts (kinds x 3^LABELERS rows at most) estimates how reliable each
labeler is and how likely each pattern is personal data. A logistic span classifier is trained on these
probabilities over features that no labeler sees as well: the character before the candidate, its words,
digits close before it, and whether its document holds base spans. It scores every candidate; candidates of
0.5 and more that overlap no base span are added.

Null text is empty. An empty table gives no rows. Positions are code points, the end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.session import stage

BASE = ["email", "ip", "card", "phone"]
ADDED = ["account", "local", "person", "ssn"]
LABELERS = ["shape", "gazetteer", "cue", "against", "edges", "plain", "opens"]
CONTEXT = ["left", "words", "digits_before", "beside"]

# The dealt patterns, written so that the engine never tries one run of characters twice: a match can
# only begin where its run begins or where the last match ended (\G), and runs are not given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Titles and cues, a short gazetteer, words that speak for and against personal data.
CUE = (
    "call|phone|tel|mobile|fax|contact|reach|card|account|iban|ssn|security|passport|customer|patient|name|dear|signed|regards|"
    "ask for|speak to|met|born|lives|resident|anruf|telefon|konto|kunde|patient|name|heißt|wohnt|grüße|fragen sie|"
    "llame|cuenta|cliente|paciente|nombre|pregunte por|atentamente|vive|compte|appelez|client|patiente|nom|demandez|habite"
)
AGAINST = "isbn|order|invoice|version|page|chapter|figure|id|hash|token|key|sha|build|issue|number of|total|secret|password"
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señor|Señora|Sr|Sra|Monsieur|Madame|Mme"
NAMES = (
    "James|Mary|John|Anna|Maria|Peter|Paul|Michael|Thomas|Laura|Jean|Marie|Pierre|Hans|Klaus|Carlos|Jose|José|Luis|Ana|David|Sarah|"
    "Robert|Linda|William|Elizabeth|Richard|Susan|Joseph|Jessica|Charles|Karen|Daniel|Nancy|Matthew|Lisa|Mark|Emma|George|Alice|"
    "Jürgen|Wolfgang|Stefan|Andreas|Sabine|Petra|Monika|Ursula|Heike|Karl|Fritz|Greta|Jan|Lukas|Katrin|Uwe|Dieter|Ingrid|"
    "Juan|Pedro|Miguel|Antonio|Francisco|Javier|Carmen|Isabel|Pilar|Lucía|Elena|Rosa|Marta|Diego|Pablo|Sofía|"
    "Jacques|Michel|François|Nicolas|Philippe|Louis|Claire|Camille|Julie|Sophie|Nathalie|Isabelle|Luc|Henri|Hélène|Chloé"
)
# Words that begin a run of capitals without being part of a name, and words of places and firms.
OPENERS = (
    "The|A|An|In|On|At|And|But|Or|If|We|He|She|It|They|You|This|That|For|From|To|Of|By|With|Our|My|Call|Phone|Contact|Dear|Ask|Der|Die|Das|"
    "Kunde|Kundin|Patient|Patientin|Customer|Client|Cliente|Name|Nombre|Nom|Konto|Account|Fragen|Appelez|Llame|"
    "Ein|Eine|Und|Aber|Im|Am|Zu|Von|Mit|Für|Ich|Wir|Sie|Er|Es|El|La|Los|Las|Un|Una|Y|En|De|Del|Por|Para|Con|Le|Les|L|Une|Et|Dans|Du|Des|Au|Pour|Avec"
)
PLACES = (
    "Street|Road|Avenue|City|River|Lake|House|Park|Company|Inc|Ltd|Bank|University|School|Hospital|Times|News|Church|Airport|Station|Union|States|"
    "Straße|Strasse|Platz|Stadt|Haus|Gmbh|Universität|Kirche|Bahnhof|Calle|Plaza|Ciudad|Banco|Universidad|Rue|Place|Ville|Banque|Université|Gare"
)
_WORD = "[A-ZÀ-Ý][a-zà-ÿ]{1,20}"
CANDIDATES = (
    r"(?<![0-9A-Za-zÀ-ÿ])(?:"
    r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
    r"|\([0-9]{2,5}\)[\x20-]?[0-9]{3,4}[\x20-]?[0-9]{3,5}"
    r"|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}"
    r"|[0-9](?:[\x20-]?[0-9]){8,18}+"
    rf"|(?:{TITLES})\.?\x20{_WORD}(?:\x20{_WORD}){{0,2}}"
    rf"|(?!(?:{OPENERS})\x20){_WORD}(?:\x20{_WORD}){{1,2}}"
    r")(?![0-9A-Za-zÀ-ÿ])"
)
SOME_CANDIDATE = rf"[0-9]{{2}}|(?:{TITLES})\.?\x20|{_WORD}\x20[A-ZÀ-Ý]"

SPANS = "array<struct<start:int,stop:int,found:string,before:string>>"


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, stop, found, before) of all matches, in code points; before: up to 40 characters.

    Matches are set between two marks that ``text`` doesn't hold; odd pieces are matches.
    """
    pieces = F.split(F.regexp_replace(text, pattern, "\u0001$0\u0001"), "\u0001", -1)
    # Positions add up from left to right, over matches and the text between them.
    summed = F.aggregate(
        pieces,
        F.struct(
            F.lit(0).alias("at"),
            F.lit(0).alias("n"),
            F.lit("").alias("last"),
            F.array().cast(SPANS).alias("out"),
        ),
        lambda s, piece: F.struct(
            (s["at"] + F.length(piece)).alias("at"),
            (s["n"] + 1).alias("n"),
            F.when(s["n"] % 2 == 0, F.right(piece, F.lit(40))).otherwise(s["last"]).alias("last"),
            F.when(
                s["n"] % 2 == 1,
                F.concat(
                    s["out"],
                    F.array(
                        F.struct(
                            s["at"].alias("start"),
                            (s["at"] + F.length(piece)).alias("stop"),
                            piece.alias("found"),
                            s["last"].alias("before"),
                        )
                    ),
                ),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
        lambda s: s["out"],
    )
    return F.when(text.rlike(pattern), summed).otherwise(F.array().cast(SPANS))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(found: Column) -> Column:
    doubled = F.transform(
        F.filter(F.split(F.reverse(_digits(found)), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x) % 10 == 0


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: F.forall(
        F.split(m, "[.]"), lambda p: F.when(F.length(F.regexp_replace(p, "^0+", "")) <= 3, F.right(p, F.lit(3)).cast("int") <= 255).otherwise(False)
    ),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}


def _passing(kind: str, spans: Column) -> Column:
    return F.filter(spans, lambda m: CHECKS[kind](m["found"]))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans_<kind> of the base kinds, and candidates of the added kinds."""
    # Two control characters give way to a third; no pattern can hold any of them.
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "\u0001", "\u0003")
    columns = []
    guard = {"email": F.col("body").contains("@"), "phone": F.col("body").contains("+"), "ip": F.col("digits"), "card": F.col("digits")}
    nothing = F.array().cast(SPANS)
    for kind, pattern in PATTERNS.items():
        spans = _passing(kind, _matches(F.col("body"), pattern))
        columns.append(F.when(guard[kind], spans).otherwise(nothing).alias(f"spans_{kind}"))
    candidates = F.when(F.col("some"), _matches(F.col("body"), CANDIDATES)).otherwise(nothing)
    return (
        docs.select("doc_id", text.alias("body"))
        .withColumn("digits", F.col("body").rlike("[0-9]"))
        .withColumn("some", F.col("body").rlike(SOME_CANDIDATE))
        .select("doc_id", *columns, candidates.alias("candidates"))
    )


def _votes(c: Column) -> dict[str, Column]:
    """Each labeler's vote on a candidate."""
    found, before = c["found"], F.lower(c["before"])
    digits = _digits(found)
    n = F.length(digits)
    shape = (
        F.when(found.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), 1)
        .when(found.rlike(r"^\([0-9]{2,5}\)"), 1)
        .when((n >= 13) & _luhn(found), 1)
        .when(n >= 13, -1)
        .when(found.rlike(rf"^(?:{TITLES})\.?\x20"), 1)
        .when(found.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), -1)
        .otherwise(0)
    )
    person = found.rlike("^[A-ZÀ-Ý]")
    gazetteer = (
        F.when(person & found.rlike(rf"\b(?:{PLACES})\b"), -1)
        .when(found.rlike(rf"\b(?:{NAMES})\b"), 1)
        .when((n >= 13) & digits.rlike("^[3-6]"), 1)
        .when((n >= 13) & digits.rlike("^0"), -1)
        .otherwise(0)
    )
    cue = F.when(before.rlike(rf"\b(?:{CUE})\b[^.]*$"), 1).otherwise(0)
    against = F.when(before.rlike(rf"\b(?:{AGAINST})\b[^.]*$"), -1).when(before.rlike(r"[$€£=#\"]\x20?$"), -1).otherwise(0)
    edges = F.when(before.rlike(r"(?:^|[\s(:])$"), 1).otherwise(-1)
    plain = F.when(digits.rlike(r"^([0-9])\1{5,}$"), -1).when(digits.rlike("^(?:0123|1234|9876)"), -1).otherwise(0)
    titled = found.rlike(rf"^(?:{TITLES})\.?\x20")
    opens = F.when(person & ~titled & before.rlike(r"(?:^|[.!?\n]\s*)$"), -1).otherwise(0)
    return dict(zip(LABELERS, (shape, gazetteer, cue, against, edges, plain, opens), strict=True))


def _context(c: Column, beside: Column) -> dict[str, Column]:
    """What the classifier sees besides the votes: small whole numbers."""
    found, before = c["found"], c["before"]
    left = (
        F.when(before == "", 0).when(before.rlike(r"[(\[]$"), 1).when(before.rlike(r"[:=]\x20?$"), 2).when(before.rlike(r",\x20$"), 3)
        .when(before.rlike(r"\s$"), 4).otherwise(5)
    )
    words = F.least(F.size(F.split(found, r"[\x20-]")), F.lit(5))
    digits = F.when(before.rlike("[0-9]"), 1).otherwise(0)
    return dict(zip(CONTEXT, (left, words, digits, beside), strict=True))


def _kind(found: Column) -> Column:
    return (
        F.when(found.rlike("^[A-ZÀ-Ý]"), "person")
        .when(found.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(found.rlike(r"^\(|^[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}$"), "local")
        .otherwise("account")
    )


def reliabilities(counts: list[tuple[tuple[int, ...], int]], rounds: int = 40) -> tuple[float, list[dict[tuple[int, int], float]]]:
    """EM over vote patterns: the share of personal data and, per labeler, P(vote | truth).

    Starts from the majority vote; counts are smoothed by one, so no probability becomes 0.
    """
    belief = [1 / (1 + math.exp(-sum(votes))) for votes, _ in counts]
    share, table = 0.5, []
    for _ in range(rounds):
        total = sum(n for _, n in counts)
        share = (sum(b * n for b, (_, n) in zip(belief, counts, strict=True)) + 1) / (total + 2)
        table = []
        for k in range(len(counts[0][0])):
            mass = {(v, y): 1.0 for v in (-1, 0, 1) for y in (0, 1)}
            for b, (votes, n) in zip(belief, counts, strict=True):
                mass[votes[k], 1] += b * n
                mass[votes[k], 0] += (1 - b) * n
            whole = [sum(mass[v, y] for v in (-1, 0, 1)) for y in (0, 1)]
            table.append({(v, y): mass[v, y] / whole[y] for v, y in mass})
        belief = [posterior(share, table, votes) for votes, _ in counts]
    return share, table


def posterior(share: float, table: list[dict[tuple[int, int], float]], votes: tuple[int, ...]) -> float:
    yes, no = math.log(share), math.log(1 - share)
    for k, v in enumerate(votes):
        yes, no = yes + math.log(table[k][v, 1]), no + math.log(table[k][v, 0])
    return 1 / (1 + math.exp(min(700.0, no - yes)))


def span_classifier(rows: list[tuple[tuple, float, int]], steps: int = 300) -> dict:
    """Weights of a logistic regression from (features, probability, count) by gradient descent."""
    weights: dict = {}
    total = sum(n for _, _, n in rows) or 1
    for _ in range(steps):
        grad: dict = {}
        for features, truth, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights.get(f, 0.0) for f in features)))))
            for f in features:
                grad[f] = grad.get(f, 0.0) + (truth - p) * n / total
        for f, g in grad.items():
            weights[f] = weights.get(f, 0.0) * 0.9995 + 2.0 * g
    return weights


def train(candidates: DataFrame) -> dict:
    """Weights of the span classifier; ``candidates`` has kind, size, the votes and the context."""
    # Bounded by 4 kinds, 7 sizes, 3^7 votes and 120 contexts, of which few occur.
    patterns = candidates.groupBy("kind", "size", *LABELERS, *CONTEXT).count().collect()
    counts: dict[tuple[int, ...], int] = {}
    for r in patterns:
        votes = tuple(r[x] for x in LABELERS)
        counts[votes] = counts.get(votes, 0) + r["count"]
    if not counts:
        return {}
    share, table = reliabilities(sorted(counts.items()))
    rows = []
    for r in sorted(patterns):
        votes = tuple(r[x] for x in LABELERS)
        features = (
            "bias", ("kind", r["kind"]), ("size", r["size"]),
            *((x, v) for x, v in zip(LABELERS, votes, strict=True) if v),
            *((x, r[x]) for x in CONTEXT),
        )
        rows.append((features, posterior(share, table, votes), r["count"]))
    return span_classifier(rows)


def find_personal(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, one array of (start, stop, found) for each base kind, and ``added``:
    (kind, start, stop, found) of the spans that the classifier adds."""
    spans = stage(found_spans(docs), "pii-spans")
    every = F.concat(*[F.col(f"spans_{k}") for k in BASE])
    beside = F.when(F.size(every) > 0, 1).otherwise(0)
    votes = F.transform(
        "candidates",
        lambda c: F.struct(
            _kind(c["found"]).alias("kind"),
            F.least(F.floor(F.length(_digits(c["found"])) / 3), F.lit(6)).cast("int").alias("size"),
            c["start"].alias("start"),
            c["stop"].alias("stop"),
            c["found"].alias("found"),
            *[v.alias(name) for name, v in _votes(c).items()],
            *[v.alias(name) for name, v in _context(c, F.col("beside")).items()],
        ),
    )
    free = F.filter(votes, lambda c: ~F.exists("every", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    voted = stage(
        spans.withColumns({"every": every, "beside": beside}).select("doc_id", *[f"spans_{k}" for k in BASE], free.alias("candidates")), "pii-votes"
    )
    weights = train(voted.select(F.explode("candidates").alias("c")).select("c.*"))

    def score(c: Column) -> Column:
        out = F.lit(weights.get("bias", -1.0))
        for f, w in weights.items():
            if f != "bias":
                out = out + F.when(c[f[0]] == f[1], F.lit(w)).otherwise(F.lit(0.0))
        return out

    added = F.filter("candidates", lambda c: score(c) >= 0) if weights else F.filter("candidates", lambda c: F.lit(False))
    return voted.select("doc_id", *[f"spans_{k}" for k in BASE], added.alias("added"))


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""

    def listed(spans: Column, kind: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", kind, s["start"].cast("string"), s["stop"].cast("string")))

    def of_kind(kind: str) -> Column:
        return F.filter("added", lambda s: s["kind"] == kind)

    base = F.concat(*[listed(F.col(f"spans_{k}"), F.lit(k)) for k in BASE])
    more = F.concat(*[listed(of_kind(k), F.lit(k)) for k in ADDED])
    return find_personal(docs).select(
        "doc_id",
        *[F.size(f"spans_{k}").cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(base, more), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
