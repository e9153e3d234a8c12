"""Secret scans with an incremental blob ledger.

Contents are addressed by their SHA-256, so a text is one blob however many paths and versions hold it. The ledger has
a row for each scan of a blob: the rule versions applied and what they found. A run scans only blobs with rule versions
the ledger lacks for them, and only by those; its rows are appended in one write, which is the record of the scan and
its findings at once. Findings are then joined back to every path.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm.common import arrow_map, text_or_empty
from assayer.sources.storage import path_exists

FOUND = "array<struct<rule:string,start:int,end:int>>"
LEDGER = f"blob string, rules array<string>, found {FOUND}"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``, kept when ``group`` has ``least`` characters.

    Texts whose lower-cased form has none of ``hints`` are passed over; no hints means every text is searched. A change
    of a rule needs a new ``version``: the ledger knows rules by name and version.
    """

    name: str
    version: int
    pattern: re.Pattern[str]
    least: int = 0
    group: int = 0
    hints: tuple[str, ...] = ()
    #: A match begins at the first ASCII letter of the run of these characters before it.
    lead: frozenset[str] = frozenset()

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"

    def spans(self, text: str, lower: str) -> Iterator[tuple[int, int]]:
        if self.hints and not any(hint in lower for hint in self.hints):
            return
        end = 0
        for match in self.pattern.finditer(text):
            if match.end(self.group) - match.start(self.group) < self.least:
                continue
            start = match.start()
            if self.lead:
                while start > end and text[start - 1] in self.lead:
                    start -= 1
                while start < match.start() and text[start] not in _LETTERS:
                    start += 1
                if start == match.start():
                    continue
            end = match.end()
            yield start, end


_LETTERS = frozenset(string.ascii_letters)
_SCHEME = _LETTERS | frozenset(string.digits + "+.-")

#: In the order that settles ties. The first three are the base; runs below 24 hex digits never match, which gives the
#: same matches as dropping them afterwards, since a run is always matched whole.
RULES = (
    Rule(
        "assign",
        1,
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
        least=6,
        group=2,
        hints=("passw", "secret", "token", "apikey", "api_key"),
    ),
    Rule("access", 1, re.compile(r"AKIA[A-Z0-9]+"), least=20, hints=("akia",)),
    Rule("hex", 1, re.compile(r"[0-9a-f]{24,}"), least=24),
    Rule("pem", 1, re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"), hints=("-----begin",)),
    Rule("github", 1, re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), hints=("xox",)),
    Rule("jwt", 1, re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), hints=("eyj",)),
    # A user and a password of any length in a URL. Its scheme is looked for backwards, so long runs are read once.
    Rule("url", 2, re.compile(r"://[^\s/:@]+:[^\s/:@]+@"), hints=("://",), lead=_SCHEME),
)
BASE = ("assign", "access", "hex")


def find_secrets(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(rule id, start, end) in code points, by start and then in the order of the rules."""
    lower = text.lower()
    found = [(start, order, end) for order, rule in enumerate(rules) for start, end in rule.spans(text, lower)]
    return [(rules[order].id, start, end) for start, order, end in sorted(found)]


def blob_of(text: str) -> Column:
    return F.sha2(text_or_empty(text).cast("binary"), 256)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; none where nothing has been written yet."""
    return spark.read.schema(LEDGER).parquet(ledger) if path_exists(spark, ledger) else spark.createDataFrame([], LEDGER)


def scan_unseen(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> None:
    """Scans the blobs of ``docs`` by the rule versions that ``ledger`` (a path in shared storage) lacks, and appends.

    Each blob is scanned where one of its documents, the one with the least key, is read.
    """
    spark = docs.sparkSession
    wanted = F.array(*[F.lit(r.id) for r in rules])
    content = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("_text"), blob_of(text).alias("blob"))
    first = content.groupBy("blob").agg(F.min("_key").alias("_first"))
    seen = read_ledger(spark, ledger).groupBy(F.col("blob").alias("_seen")).agg(F.flatten(F.collect_set("rules")).alias("_rules"))
    todo = F.array_except(wanted, F.coalesce("_rules", F.array().cast("array<string>")))
    due = first.join(seen, F.col("blob") == F.col("_seen"), "left").select(F.col("blob").alias("_blob"), "_first", todo.alias("_todo"))
    due = due.filter(F.size("_todo") > 0)
    same = (F.col("blob") == F.col("_blob")) & F.col("_key").eqNullSafe(F.col("_first"))
    by_id = {r.id: r for r in rules}

    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        asked = batch.column(2).to_pylist()
        found = []
        for cell, todo in zip(batch.column(1), asked, strict=True):
            spans = find_secrets(cell.as_py(), tuple(by_id[i] for i in todo))
            found.append([{"rule": rule, "start": start, "end": end} for rule, start, end in spans])
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        columns = [batch.column(0), pa.array(asked, pa.list_(pa.string())), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["blob", "rules", "found"])

    texts = content.join(due, same).select("blob", "_text", "_todo")
    arrow_map(texts, each, LEDGER).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, found``: of each blob with findings by these rule versions, all of them, by start and rule order."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.id, i)])
    rows = read_ledger(spark, ledger).filter(F.size("found") > 0)
    # A blob has a row for each run that scanned it: its number is bounded by rule versions, not by documents.
    merged = rows.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("_found"))
    known = F.filter("_found", lambda f: F.element_at(order, f["rule"]).isNotNull())
    keyed = F.transform(known, lambda f: F.struct(f["start"].alias("start"), F.element_at(order, f["rule"]).alias("order"), f["end"].alias("end")))
    names = F.array(*[F.lit(r.name) for r in rules])
    named = F.transform(
        F.sort_array(keyed),
        lambda f: F.struct(F.get(names, f["order"]).alias("rule"), f["start"].alias("start"), f["end"].alias("end")),
    )
    return merged.select("blob", named.alias("found")).filter(F.size("found") > 0)


def with_findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``row, found``: each row of ``docs`` as a struct and the findings of its blob, null where there are none.

    Scans what is due first.
    """
    scan_unseen(docs, ledger, rules, key, text)
    found = findings(docs.sparkSession, ledger, rules)
    rows = docs.select(F.struct("*").alias("row"), blob_of(text).alias("of"))
    return rows.join(found, F.col("of") == F.col("blob"), "left").select("row", "found")


def secret_digest(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` lists all findings as kind:start:end (code points, end exclusive) by start and rule order, joined by
    commas; ``base_sha256`` is the SHA-256 of such a list of the base kinds alone.

    A null text is the empty blob. Repeated rows and copies share a blob, which is scanned once. Columns other than the
    two named are ignored. An empty table gives an empty result.
    """
    kept = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = F.coalesce("found", F.array().cast(FOUND))

    def shown(list_of: Column) -> Column:
        return F.array_join(F.transform(list_of, lambda f: F.concat_ws(":", f["rule"], f["start"], f["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda f: f["rule"] == kind)).cast("bigint").alias(f"n_{kind}")

    rows = with_findings(kept, ledger, rules).select("row.doc_id", found.alias("found"))
    base = F.filter("found", lambda f: f["rule"].isin(*BASE))
    return rows.select("doc_id", *[number(k) for k in BASE], F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"))


def redacted(
    docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """``docs``, all of them, with every finding in the text, overlapping ones as one, replaced by ``mark``.

    Texts without findings, null ones too, stay as they are.
    """
    whole = docs.withColumn(text, F.col(text).cast("string"))
    content = F.col(f"row.`{text}`")

    def replaced(state: Column, span: Column) -> Column:
        before = F.concat(state["out"], F.substring(content, state["at"] + 1, span["start"] - state["at"]), F.lit(mark))
        out = F.when(span["start"] >= state["at"], before).otherwise(state["out"])
        return F.struct(out.alias("out"), F.greatest(state["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    rest = F.aggregate("found", start, replaced, lambda state: F.concat(state["out"], F.substring(content, state["at"] + 1, F.length(content))))
    rows = with_findings(whole, ledger, rules, key, text)
    return rows.select(F.col("row").withField(f"`{text}`", F.when(F.col("found").isNull(), content).otherwise(rest)).alias("row")).select("row.*")
