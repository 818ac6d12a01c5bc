"""Personal data by weak supervision, in DataFrame functions only.

Wide patterns propose spans of four kinds. Spans of the base patterns that pass their
checks always count. For the others, regex, gazetteer and context labelers vote for,
against, or not at all; expectation-maximisation over the grouped votes of the whole
table estimates how reliable each labeler is, and a logistic classifier over votes and
form, trained on the resulting posteriors, decides. Votes are grouped first, so a round
of either fit reads at most 3 ** labelers rows per kind.

Positions come from splitting a text by the pattern: the lengths of what lies between
the matches, added up by a window per document. The patterns take runs of letters or
digits possessively and start only where a run (or the rest after a match) starts: same
matches as the plain patterns, in linear time and without recursion on long texts.

Rules for unusual rows: a null or empty text has no spans; a null doc_id is kept;
repeated rows are returned once each; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep

KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# wider forms; what a base span covers is left out later
WIDE = {
    "email": r"(?i)(?:\G|(?<![A-Z0-9._%+-]))[A-Z0-9._%+-]++\x20?(?:\(at\)|\[at\]|\{at\})\x20?[A-Z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\]|\{dot\})\x20?[A-Z0-9-]++)++",
    "ip": r"(?i)(?<![0-9A-F:])(?:[0-9A-F]{1,4}:){7}[0-9A-F]{1,4}(?![0-9A-F:])"
    r"|(?<![\p{L}\p{N}_:])(?:[0-9A-F]{1,4}(?::[0-9A-F]{1,4}){0,6}::(?:[0-9A-F]{1,4}(?::[0-9A-F]{1,4}){0,5})?|::[0-9A-F]{1,4}(?::[0-9A-F]{1,4}){0,6})(?![\p{L}\p{N}_:])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{3,7}){2,3})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[.\x20-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
}
# cheap tests that a text must pass before a pattern is run on it
MAY_HOLD = {
    ("email", True): ("contains", "@"),
    ("ip", True): ("rlike", r"[0-9]\.[0-9]++\.[0-9]"),
    ("card", True): ("rlike", r"[0-9][\x20-]?[0-9]"),
    ("phone", True): ("rlike", r"\+[0-9]"),
    ("email", False): ("rlike", r"(?i)[(\[{]at[)\]}]"),
    ("ip", False): ("rlike", r"(?i)(?:[0-9A-F]{1,4}:){7}|[0-9A-F]::|::[0-9A-F]"),
    ("card", False): ("rlike", r"[0-9]{4}[\x20-]?[0-9]{3}"),
    ("phone", False): ("rlike", r"[0-9]{3}[.\x20-][0-9]{4}"),
}
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = 48  # characters of context on either side
# words that speak for a kind, and words that speak against any
SPEAKS_FOR = {
    "email": "mail|contact|write|reply|from|cc|address",
    "ip": "ip|host|server|address|client|login|network|connect",
    "card": "card|visa|mastercard|amex|credit|debit|payment|paid|expir|cvv",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|contact|reach",
}
SPEAKS_AGAINST = "order|invoice|isbn|version|ver|token|hash|serial|part|ticket|build|sku|ref|no"
TOP_DOMAINS = "com|org|net|edu|gov|io|de|fr|es|uk|eu|info|biz|it|nl|ch|at|us"
COUNTRY_CODES = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38"
VOTERS = ["pattern", "check", "gazetteer", "context", "against", "joined", "grouped"]
ROUNDS = 8


def candidates(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, found): a number for each row, and the matches of all patterns with what surrounds them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    columns, parts = [], []
    for base, patterns in ((True, BASE), (False, WIDE)):
        for order, kind in enumerate(KINDS):
            how, test = MAY_HOLD[kind, base]
            name = f"{kind}_{'base' if base else 'wide'}"
            holds = getattr(text, how)(test)
            # the matches, and the pieces before, between and after them
            columns.append(F.when(holds, F.regexp_extract_all(text, F.lit(patterns[kind]), F.lit(0))).alias(name))
            columns.append(F.when(holds, F.split(text, patterns[kind], -1)).alias(f"{name}_between"))
            parts.append(_matches(name, order, base))
    ids = [F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id")]
    cut = docs.select(*ids, *columns)
    return cut.select("rid", "doc_id", F.flatten(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("found"))


def _matches(name: str, order: int, base: bool) -> Column:
    """Array of the pattern's matches with position, gap to the match before, and context; null without any."""

    def one(match: Column, i: Column) -> Column:
        before, after = F.get(f"{name}_between", i), F.get(f"{name}_between", i + 1)
        return F.struct(
            F.lit(order).alias("kind"),
            F.lit(base).alias("base"),
            i.alias("i"),
            match.alias("match"),
            F.char_length(before).alias("gap"),
            F.right(before, F.lit(CONTEXT)).alias("left"),
            F.left(after, F.lit(CONTEXT)).alias("right"),
        )

    return F.when(F.size(name) > 0, F.transform(name, one))


def luhn(digits: Column) -> Column:
    """Whether the check digit holds."""
    places = F.sequence(F.lit(1), F.char_length(digits))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda acc, i: acc + _luhn_term(F.substring(digits, F.char_length(digits) - i + 1, F.lit(1)).cast("int"), i),
    )
    return total % 10 == 0


def _luhn_term(digit: Column, place: Column) -> Column:
    double = digit * 2
    return F.when(place % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)


def spans(stored: DataFrame) -> DataFrame:
    """One row per candidate: rid, kind, base, start, end, its votes and form; base matches that fail their check are gone."""
    rows = stored.select("rid", F.inline("found"))
    per_pattern = Window.partitionBy("rid", "kind", "base").orderBy("i")
    end = F.sum(F.col("gap") + F.char_length("match")).over(per_pattern)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.char_length("match"))
    digits = F.regexp_replace("match", "[^0-9]", "")
    n = F.char_length(digits)
    kind, base = F.col("kind"), F.col("base")
    right_length = n.between(16, 19)
    groups = F.size(F.filter(F.split("match", ":"), lambda x: x != ""))
    ok = (
        F.when(kind == 0, F.lit(True))
        .when(kind == 1, F.when(base, F.col("match").rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")).otherwise(groups <= F.when(F.contains("match", F.lit("::")), 7).otherwise(8)))
        .when(kind == 2, F.when(n.between(13, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )
    rows = rows.withColumn("digits", digits).withColumn("ok", ok)
    sure = base & F.col("ok") & ((kind != 2) | right_length)
    rows = rows.withColumn("sure", sure).where(F.col("sure") | ~base)
    # wide candidates that overlap a sure span of the same document go
    place = Window.partitionBy("rid").orderBy("start", "end", "kind", "base")
    sure_end = F.max(F.when(F.col("sure"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    backward = Window.partitionBy("rid").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"), F.desc("base"))
    sure_start = F.min(F.when(F.col("sure"), F.col("start"))).over(backward.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("sure_end", sure_end).withColumn("sure_start", sure_start)
    clear = F.coalesce(F.col("sure_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("sure_start") >= F.col("end"), F.lit(True))
    rows = rows.where(F.col("sure") | clear)
    return rows.select("rid", "kind", "sure", "start", "end", *_votes())


def _votes() -> list[Column]:
    """Each labeler's vote as 1 (personal data), -1 (not), 0 (no opinion)."""
    kind, near = F.col("kind"), F.lower(F.concat("left", F.lit(" "), "right"))

    def by_kind(make) -> Column:
        column = F.when(kind == 0, make("email"))
        for order, name in enumerate(KINDS[1:], 1):
            column = column.when(kind == order, make(name))
        return column

    def vote(yes: Column, no: Column | None = None) -> Column:
        column = F.when(yes, 1)
        return (column.when(no, -1) if no is not None else column).otherwise(0)

    issuer = F.col("digits").rlike(f"^(?:{ISSUERS})")
    gazetteer = {
        "email": vote(F.lower("match").rlike(rf"(?:{TOP_DOMAINS})$"), F.lower("match").rlike(r"[0-9]$")),
        "ip": vote(~F.col("match").rlike(r"^(?:0|255|127)\."), F.col("match").rlike(r"^0\.")),
        "card": vote(issuer, ~issuer),
        "phone": vote(F.col("match").rlike(rf"^\+(?:{COUNTRY_CODES})"), F.col("match").rlike(r"^\+?0")),
    }
    joined = F.col("left").rlike(r"[\p{L}\p{N}_]$") | F.col("right").rlike(r"^[\p{L}\p{N}_]")
    grouped = {
        "email": F.col("match").rlike(r"[._]"),
        "ip": F.lit(False),
        "card": F.col("match").rlike(r"^[0-9]{4}(?:([\x20-])[0-9]{4})(?:\1[0-9]{4})+"),
        "phone": F.col("match").rlike(r"[0-9]{3}[.\x20-][0-9]{4}$"),
    }
    columns = [
        vote(F.col("sure")),
        vote(F.col("ok"), ~F.col("ok")),
        by_kind(gazetteer.get),
        by_kind(lambda k: vote(near.rlike(rf"\b(?:{SPEAKS_FOR[k]})"))),
        F.when(near.rlike(rf"\b(?:{SPEAKS_AGAINST})\b"), -1).otherwise(0),
        F.when(joined, -1).otherwise(0),
        by_kind(lambda k: vote(grouped[k])),
    ]
    return [c.cast("int").alias(v) for c, v in zip(columns, VOTERS, strict=True)]


def _table(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _name(voter: str) -> Column:
    """kind/labeler/vote"""
    return F.concat_ws("/", F.col("kind").cast("string"), F.lit(voter), F.col(voter).cast("string"))


def _log_odds(weights: dict[str, float]) -> Column:
    """Sum of the weights of a row's votes and of its kind."""
    table = _table(weights)
    constant = table[F.concat_ws("/", F.col("kind").cast("string"), F.lit("kind"))]
    return sum((F.coalesce(table[_name(v)], F.lit(0.0)) for v in VOTERS), F.coalesce(constant, F.lit(0.0)))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def reliabilities(grouped: DataFrame) -> dict[str, float]:
    """Weights of evidence of every labeler and vote, by expectation-maximisation over (kind, votes, n).

    Labelers are independent given the truth; they start as slightly better than chance.
    """
    weights = {f"{k}/{v}/{s}": s * 1.0 for k in range(len(KINDS)) for v in VOTERS for s in (-1, 1)}
    for _ in range(ROUNDS):
        posterior = _sigmoid(_log_odds(weights))
        marked = grouped.withColumn("p", posterior)
        names = F.array(F.concat_ws("/", F.col("kind").cast("string"), F.lit("kind")), *[_name(v) for v in VOTERS])
        sums = marked.select(F.explode(names).alias("name"), (F.col("n") * F.col("p")).alias("yes"), (F.col("n") * (1 - F.col("p"))).alias("no"))
        total = {r.name: (r.yes, r.no) for r in sums.groupBy("name").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()}
        new = {}
        for name, (yes, no) in total.items():
            kind = name.split("/")[0]
            all_yes, all_no = total[f"{kind}/kind"]
            if name.endswith("/kind"):
                new[name] = math.log((yes + 1) / (no + 1))
            elif not name.endswith("/0"):  # silence is no evidence
                new[name] = math.log((yes + 1) / (all_yes + 3)) - math.log((no + 1) / (all_no + 3))
        weights = new
    return weights


def classifier(grouped: DataFrame, reliability: dict[str, float]) -> dict[str, float]:
    """Logistic weights of votes and kinds, fitted to the posteriors by damped diagonal Newton steps."""
    target = _sigmoid(_log_odds(reliability))
    names = F.array(F.concat_ws("/", F.col("kind").cast("string"), F.lit("kind")), *[_name(v) for v in VOTERS])
    weights: dict[str, float] = {}
    for _ in range(ROUNDS):
        p = _sigmoid(_log_odds(weights)) if weights else F.lit(0.5)
        marked = grouped.withColumn("target", target).withColumn("p", p)
        step = marked.select(
            F.explode(names).alias("name"),
            (F.col("n") * (F.col("target") - F.col("p"))).alias("g"),
            (F.col("n") * F.col("p") * (1 - F.col("p"))).alias("h"),
        )
        for r in step.groupBy("name").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
            old = weights.get(r.name, 0.0)
            weights[r.name] = old + (r.g - 0.1 * old) / (r.h + 1) / 3
    return weights


def find(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, counts and digest of the base spans, and all spans as text kind:start:end."""
    stored = keep(candidates(docs), "pii-candidates")
    rows = keep(spans(stored), "pii-spans")
    # at most 3 ** labelers rows per kind
    grouped = keep(rows.groupBy("kind", *VOTERS).agg(F.count("*").alias("n")).coalesce(1), "pii-votes")
    weights = classifier(grouped, reliabilities(grouped)) if not grouped.isEmpty() else {}
    decided = rows.where(F.col("sure") | (_sigmoid(_log_odds(weights)) >= 0.5)) if weights else rows
    entry = F.struct("kind", "start", "end", "sure")
    listed = decided.groupBy("rid").agg(F.sort_array(F.collect_list(entry)).alias("s"))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def joined(column: Column) -> Column:
        one = F.transform(column, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(one, ",")

    every = F.coalesce(F.col("s"), F.array().cast("array<struct<kind:int,start:bigint,end:bigint,sure:boolean>>"))
    result = stored.select("rid", "doc_id").join(listed, "rid", "left").withColumn("s", every)
    sure = F.filter("s", lambda x: x["sure"])
    of_kind = F.transform(sure, lambda x: x["kind"])
    counts = [(F.size(sure) - F.size(F.array_remove(of_kind, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return result.select("doc_id", *counts, F.sha2(joined(sure), 256).alias("base_sha256"), joined(F.col("s")).alias("spans"))
