"""Secret scans (operator 8, native): an incremental blob ledger.

Every text is content-addressed by SHA-256. The ledger (a Parquet table under
``ledger``) holds, per blob, the versions of the rules that have scanned it and
their findings. A run scans each unseen pair of blob and rule version once,
whatever number of paths (rows) hold the blob, appends to the ledger, and joins
the findings back to all rows. A rule's version is the hash of its name,
pattern and length bound, so a changed or added rule scans old blobs again by
that rule alone.

Only DataFrame functions: places of matches come from the pieces between them
(``split`` keeps every piece), lengths in code points.

Null text is the empty blob. Empty and secret-free texts have no spans. Texts
of any length are scanned whole, in time linear in their matches; null ids are
ids like others. Repeated rows share one blob; a hot blob's rows are
pre-aggregated on the map side and salted, by all other columns, on the way back. The ledger may be shared by many tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int

    @property
    def version(self) -> str:
        return hashlib.sha256(f"{self.kind}\0{self.pattern}\0{self.group}\0{self.least}".encode()).hexdigest()[:16]


# The contract's base rules in listed order. A run of 16 or 32
# characters at least is the maximal run that passes the length test.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
# Public token formats and key headers that the method adds.
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)
RULES = BASE_RULES + MORE_RULES
#: Matches whose places are summed at once.
LOT = 128
_FOUND = "array<struct<start:int,end:int,version:string>>"
_SPANS = "array<struct<start:int,order:int,kind:string,end:int>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def match_spans(text: Column, rule: Rule) -> Column:
    """Spans of a rule's leftmost non-overlapping matches that pass its length
    test, as (start, end, rule version), in code points."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    sized = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
                         F.transform(whole, lambda x: F.length(x)).alias("size"),
                         F.transform(tested, lambda x: F.length(x)).alias("tested"))
    # an array grows by copying, so places are summed in lots: first the lots' lengths, then inside each
    def length(m: Column) -> Column:
        return m["gap"] + F.coalesce(m["size"], F.lit(0))

    def starts(lots: Column) -> Column:
        lengths = F.transform(lots, lambda lot: F.aggregate(lot, F.lit(0), lambda n, m: n + length(m)))
        return F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.lit([]).cast("array<int>").alias("all")),
                           lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
                           lambda acc: acc["all"])

    def step(acc: Column, m: Column) -> Column:
        lo = acc["at"] + m["gap"]
        hi = lo + F.coalesce(m["size"], F.lit(0))
        span = F.struct(lo.alias("start"), hi.alias("end"), F.lit(rule.version).alias("version"))
        return F.struct(hi.alias("at"), F.when(m["tested"] >= rule.least, F.concat(acc["spans"], F.array(span)))
                        .otherwise(acc["spans"]).alias("spans"))

    def spans(lots: Column) -> Column:
        return F.flatten(F.transform(F.arrays_zip(lots.alias("lot"), starts(lots).alias("at")), lambda x: F.aggregate(
            x["lot"], F.struct(x["at"].alias("at"), F.lit([]).cast(_FOUND).alias("spans")), step, lambda acc: acc["spans"])))

    def cut(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / LOT).cast("int")), lambda i: F.slice(all_, i * LOT + 1, LOT))

    found = _let(sized, lambda all_: _let(cut(all_), spans))
    return F.when(text.rlike(rule.pattern), found).otherwise(F.lit([]).cast(_FOUND))


def read_ledger(docs: DataFrame, ledger: str) -> DataFrame | None:
    try:
        return docs.sparkSession.read.parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def scan_new(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scan unseen (blob, rule version) pairs, append them to the ledger and
    return the whole ledger."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one text a blob; copies meet in the map-side aggregate first
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(
        F.first("text").alias("text"))
    versions = [r.version for r in rules]
    old = read_ledger(docs, ledger)
    if old is None:
        blobs = blobs.withColumn("missing", F.lit(versions))
    else:
        seen = old.groupBy("blob").agg(F.flatten(F.collect_set("versions")).alias("seen"))
        blobs = (blobs.join(seen, "blob", "left")
                 .withColumn("missing", F.array_except(F.lit(versions), F.coalesce("seen", F.lit([]).cast("array<string>"))))
                 .where(F.size("missing") > 0))
    none = F.lit([]).cast(_FOUND)
    found = [F.when(F.array_contains("missing", r.version), match_spans(F.col("text"), r)).otherwise(none) for r in rules]
    spans = F.filter(F.array(*found), lambda x: F.size(x) > 0)
    new = blobs.select("blob", F.col("missing").alias("versions"), F.flatten(spans).alias("spans"))
    new.write.mode("append").parquet(ledger)
    return docs.sparkSession.read.parquet(ledger)


def secret_scan(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(doc_id, blob, spans) of every row: findings of the current rule
    versions, by start, then rule order."""
    table = scan_new(docs, ledger, rules, text_col)
    order = F.create_map(*[F.lit(x) for k, r in enumerate(rules) for x in (r.version, k)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.kind)])
    current = F.lit([r.version for r in rules])
    wanted = F.filter("spans", lambda s: F.array_contains(current, s["version"]))
    # only findings travel back: blobs without any are left out of the join
    findings = (table.where(F.size("spans") > 0).groupBy("blob").agg(F.flatten(F.collect_list(wanted)).alias("found"))
                .select("blob", F.array_sort(F.array_distinct(F.transform("found", lambda s: F.struct(
                    s["start"].alias("start"), order[s["version"]].alias("order"), kind[s["version"]].alias("kind"),
                    s["end"].alias("end"))))).alias("found")))
    spread = F.xxhash64(F.lit(0), *[F.col(c) for c, t in docs.dtypes if c != text_col and not t.startswith("map")])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.pmod(spread, F.lit(64)).cast("int").alias("salt"),
                       F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("blob"))
    return with_findings(rows, findings)


def with_findings(rows: DataFrame, findings: DataFrame) -> DataFrame:
    """Findings to every row (doc_id, salt, blob) of their blob. A blob's findings go only to the
    salts its rows have, so a hot blob is spread."""
    salts = rows.groupBy("blob", "salt").count().select("blob", "salt")
    back = salts.join(findings, "blob")
    return (rows.join(back, ["blob", "salt"], "left")
            .select("doc_id", "blob", F.coalesce("found", F.lit([]).cast(_SPANS)).alias("spans")))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")
