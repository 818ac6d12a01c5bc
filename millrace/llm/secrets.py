"""Secrets in text: pattern candidates, false positives removed by a random forest.

Candidates are quoted or assigned values, well-known key formats, and long runs without
white space. A forest judges each by its length, its transitions between kinds of
characters, how much of it is made of common words, whether it stands in a path or an
address, and the words next to it. It is trained from labelled findings: rows of
candidate, context and label. Without a table of them, findings are labelled in the
documents themselves where the case is clear: known formats and values assigned to a
secret's name are secrets; words, numbers, addresses, paths, and values called an
example or a checksum are not. Unclear candidates are left for the forest.

Training takes at most SAMPLE findings of each label, in the order of a hash; every
candidate of every document is judged.

A candidate is one span of any length: a long value, run or key (with its header lines) is judged and masked whole.

Rules for unusual rows: a null or empty text has no candidates; a null doc_id is kept;
repeated rows are judged each; other columns are ignored. Where clear findings have only
one label, or none, there is nothing to train on and clear findings alone decide.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep, kept_folder

SAMPLE = 10_000
SECRET_NAMES = "token|secret|passwd|password|pwd|api_?key|apikey|access_?key|auth|credential|private_?key|client_?secret|bearer"
KNOWN_FORMATS = [
    r"AKIA[0-9A-Z]{16}",
    r"gh[pousr]_[A-Za-z0-9]{36,}",
    r"sk-[A-Za-z0-9]{20,}",
    r"xox[abprs]-[A-Za-z0-9-]{10,}",
    r"AIza[0-9A-Za-z_-]{35}",
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
]
KNOWN = re.compile("|".join(KNOWN_FORMATS))
VALUE = r"[A-Za-z0-9+/=_.~!@#$%^&*-]"
ASSIGNED = re.compile(rf"""(?i)\b([a-z0-9_-]{{0,40}}(?:{SECRET_NAMES})[a-z0-9_-]{{0,40}})["']?\s{{0,8}}(?:=>|:=|[:=])\s{{0,8}}["']?({VALUE}{{8,}})""")
# header lines such as Proc-Type may stand before the key; no part gives back what it took, and none goes past the next mark
PEM = re.compile(
    r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----\s*+(?:[A-Za-z][A-Za-z0-9-]*+:(?:[^\n-]|-(?!----))*+\n\s*+)*+"
    r"[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,30}PRIVATE KEY-----|\Z)"
)
RUN = re.compile(r"[A-Za-z0-9+/=_-]+")
SHORTEST_RUN = 20
# texts without any of these need no search for the patterns above
NAME_PARTS = ["token", "secret", "passw", "pwd", "key", "auth", "credential", "bearer"]
FORMAT_PARTS = ["AKIA", "gh", "sk-", "xox", "AIza", "eyJ"]
HEX = re.compile(r"(?i)[0-9a-f]+")
NOT_SECRET = re.compile(r"(?i)example|sample|placeholder|changeme|your[_-]|xxxx|dummy|checksum|sha1|sha256|md5|hash|uuid|commit|digest")
SPEAKS_FOR = re.compile(rf"(?i){SECRET_NAMES}|login|key")
COMMON = frozenset(
    "the and for with that this from have not are was you all can has her his one our out new now see two way who did its"
    " let put say she too use data file name code user test time page home main type text line list item next last read"
    " write value index table class public static import return string number version update delete insert select where"
    " http https www com org net html json image path node config server client default package module function object"
    " tion ing ment able ness less ance ence".split()
)
CONTEXT = 40
FEATURES = [
    "length", "entropy", "digits", "upper", "lower", "signs", "transitions", "longest_letters", "longest_digits", "kinds",
    "bigram", "dictionary", "is_hex", "path", "address", "named", "quoted", "assigned", "denied", "repeats",
]
# how likely one kind of character follows another inside ordinary words
_VOWELS = frozenset("aeiouyAEIOUY")


def kind_of(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s"


def longest(shape: str, kinds: str) -> int:
    return max((len(x) for x in re.findall(f"[{kinds}]+", shape)), default=0)


def dictionary_share(value: str) -> float:
    """Share of the characters that common words cover, longest first from the left."""
    low, covered, i = value.lower(), 0, 0
    while i < len(low):
        for n in range(min(8, len(low) - i), 2, -1):
            if low[i : i + n] in COMMON:
                covered += n
                i += n
                break
        else:
            i += 1
    return covered / max(len(low), 1)


def describe(text: str, start: int, end: int, name: str) -> list[float]:
    value = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    shape = "".join(map(kind_of, value))
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    changes = sum(a != b for a, b in zip(shape, shape[1:], strict=False))
    letters = [c for c in value if c.isalpha()]
    # words alternate vowels and consonants; random letters do so less
    swaps = sum((a in _VOWELS) != (b in _VOWELS) for a, b in zip(letters, letters[1:], strict=False))
    near = f"{before} {name}"
    return [
        min(n, 256),
        entropy,
        shape.count("d") / n,
        shape.count("u") / n,
        shape.count("l") / n,
        shape.count("s") / n,
        changes / n,
        longest(shape, "ul") / n,
        longest(shape, "d") / n,
        len(set(shape)),
        swaps / max(len(letters) - 1, 1),
        dictionary_share(value),
        float(bool(HEX.fullmatch(value))),
        float("/" in value or "\\" in before[-2:] or before.endswith("/")),
        float("://" in before or "@" in after[:1] or "www." in near),
        float(bool(SPEAKS_FOR.search(near))),
        float(before[-1:] in "\"'" if before else 0),
        float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        # what stands further off does not deny a value that has a name
        float(bool(NOT_SECRET.search(f"{name} {value}" if name else f"{before} {value} {after[:12]}"))),
        max(counts.values()) / n,
    ]


def clear_label(text: str, start: int, end: int, name: str, x: list[float]) -> int:
    """1: clearly a secret, 0: clearly none, -1: unclear."""
    f = dict(zip(FEATURES, x, strict=True))
    value = text[start:end]
    if f["denied"] or f["repeats"] > 0.5:
        return 0
    if KNOWN.fullmatch(value) or value.startswith("-----BEGIN"):
        return 1
    if name and f["digits"] > 0.05 and f["entropy"] >= 2.8 and f["length"] >= 12:
        return 1
    if f["named"]:
        return -1
    if f["digits"] in (0.0, 1.0) or f["address"] or f["dictionary"] > 0.4:
        return 0
    return -1


def candidates(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, name): spans that do not overlap; known formats first, then assigned values, then long runs."""
    if not text:
        return []
    found = [(m.start(), m.end(), "key") for m in PEM.finditer(text)] if "-----BEGIN" in text else []
    if any(map(text.__contains__, FORMAT_PARTS)):
        found += [(m.start(), m.end(), "") for m in KNOWN.finditer(text)]
    if any(map(text.lower().__contains__, NAME_PARTS)):
        found += [(*m.span(2), m.group(1)) for m in ASSIGNED.finditer(text)]
    if max(map(len, text.split()), default=0) >= SHORTEST_RUN:
        for m in RUN.finditer(text):
            a, b = m.span()
            if b - a >= SHORTEST_RUN:
                found.append((a, b, ""))
    # in order of trust; taken stays sorted, so that only the neighbours can overlap
    taken: list[tuple[int, int, str]] = []
    for span in found:
        at = bisect.bisect(taken, span)
        if (at == 0 or taken[at - 1][1] <= span[0]) and (at == len(taken) or span[1] <= taken[at][0]):
            taken.insert(at, span)
    return taken


FINDING = "start: int, end: int, label: int, x: array<double>"


def findings_column(text: Column) -> Column:
    @F.pandas_udf(f"array<struct<{FINDING}>>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            rows = []
            for start, end, name in candidates(text):
                x = describe(text, start, end, name)
                rows.append({"start": start, "end": end, "label": clear_label(text, start, end, name, x), "x": x})
            out.append(rows)
        return pd.Series(out)

    return run(text.cast("string"))


def train(findings: DataFrame, sample: int = SAMPLE, trees: int = 30, depth: int = 6, seed: int = 5):
    """A forest from labelled findings (x array<double>, label int); None where a label is missing."""
    clear = findings.where(F.col("label").isin(0, 1))
    order = F.xxhash64(F.col("x"))
    parts = [keep(clear.where(F.col("label") == y).orderBy(order).limit(sample).select("x", "label"), "secret-findings") for y in (0, 1)]
    if any(p.isEmpty() for p in parts):
        return None
    rows = parts[0].union(parts[1]).select(array_to_vector("x").alias("features"), F.col("label").cast("double").alias("label"))
    counts = [p.count() for p in parts]
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, max(counts) / counts[1]).otherwise(max(counts) / counts[0]))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", featureSubsetStrategy="sqrt").fit(rows)
    # a fresh model holds its training summary and through it the session, which tasks cannot be given
    folder = kept_folder(findings.sparkSession, "secret-forest")
    forest.write().save(folder)
    return RandomForestClassificationModel.load(folder)


def judged(findings: DataFrame, model) -> DataFrame:
    """findings with `probability`: the forest's, or that of the clear label where there is no forest."""
    if model is None:
        return findings.withColumn("probability", F.greatest(F.col("label"), F.lit(0)).cast("double"))
    scored = model.transform(findings.withColumn("features", array_to_vector("x")))
    columns = findings.columns
    return scored.select(*columns, vector_to_array("probability")[1].alias("probability"))


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """(doc_id, start, end, probability, is_secret): one row per candidate; positions in characters, end exclusive."""
    stored = keep(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(findings_column(F.col("text")))), "secret-candidates")
    found = judged(stored, train(labelled if labelled is not None else stored))
    return found.select("doc_id", "start", "end", "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def mask_secrets(docs: DataFrame, mark: str = "[SECRET]", labelled: DataFrame | None = None) -> DataFrame:
    """docs with each secret replaced by `mark`, n_chars (if there is such a column) counted anew; no row goes."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rid = F.monotonically_increasing_id().alias("rid")
    stored = keep(docs.select(rid, row, findings_column(F.col("text")).alias("found")), "secret-rows")
    findings = stored.where(F.size("found") > 0).select("rid", F.inline("found"))
    secret = judged(findings, train(labelled if labelled is not None else findings)).where("probability >= 0.5")
    spans = secret.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))  # of one text

    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, list_of in zip(texts, spans, strict=True):
            if list_of is not None and len(list_of):
                parts, at = [], 0
                for span in list_of:
                    parts += [text[at : span["start"]], mark]
                    at = span["end"]
                text = "".join(parts) + text[at:]
            out.append(text)
        return pd.Series(out)

    joined = stored.select("rid", "row").join(spans, "rid", "left")
    text = F.when(F.col("spans").isNotNull(), masked(F.col("row.text").cast("string"), "spans")).otherwise(F.col("row.text").cast("string"))
    joined = joined.select("row", "spans", text.alias("masked"))
    fields = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == "text":
            fields.append(F.col("masked").alias(c))
        elif c == "n_chars":
            kind = dict(docs.dtypes)[c]
            fields.append(F.when(F.col("spans").isNotNull(), F.char_length("masked").cast(kind)).otherwise(old).alias(c))
        else:
            fields.append(old.alias(c))
    return joined.select(*fields)
