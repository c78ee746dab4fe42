"""Secret scan over every version of every file, each distinct content scanned once.

Incremental blob ledger: texts are addressed by their SHA-256. The ledger is a Parquet
table, one folder per rule and rule version, that says which blobs the rule has seen and
what it found. A run scans only pairs of blob and rule version that the ledger lacks,
appends them, and joins the findings back to every row that holds the blob. What moves to find
the unseen pairs are addresses; texts move for unseen blobs only, one copy of each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.bitmap import with_maybe
from punctua.llm.rows import column, new_folder, packed, prepare_workers, unpacked, written

BITS, MOST_BITS = 1 << 20, 1 << 26  # of the bitmap of unseen blobs
LEDGER = "blob binary, spans array<struct<start:int,end:int>>, rule string, version int"


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if ``group`` has ``least`` characters or more.

    Give a changed rule a higher version: the ledger then counts every blob as unseen by it.
    """

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 0

    def spans(self, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
        """Leftmost matches that do not overlap, the short ones dropped afterwards."""
        g, least = self.group, self.least
        return [m.span() for m in compiled.finditer(text) if m.end(g) - m.start(g) >= least]


# Fixed values of the contract; their order also breaks ties between equal starts.
# A run of hex digits or of an access key is taken whole, so a lower bound on its length
# inside the pattern finds the same matches as one tested afterwards.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        group=2, least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
# Kinds the operator finds beyond them.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES


def read_ledger(spark, path: str) -> DataFrame:
    """All rows of the ledger; none if nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def _scan(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(f"{r.name}@{r.version}", r, re.compile(r.pattern, re.ASCII)) for r in rules]
        for batch in batches:
            blob, text, todo = (batch.column(n) for n in ("blob", "text", "todo"))
            out = {"blob": [], "spans": [], "rule": [], "version": []}
            for b, t, names in zip(blob, text, todo, strict=True):
                t, names = t.as_py() or "", set(names.as_py())
                for key, rule, pattern in compiled:
                    if key in names:
                        out["blob"].append(b.as_py())
                        found = rule.spans(pattern, t)
                        out["spans"].append([{"start": i, "end": j} for i, j in found])
                        out["rule"].append(rule.name)
                        out["version"].append(rule.version)
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema([
                    ("blob", pa.binary()),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ("rule", pa.string()),
                    ("version", pa.int32()),
                ]),
            )

    return scan


def update_ledger(df: DataFrame, ledger: str, text: str = "text", rules=RULES) -> None:
    """Scan each blob of ``df`` with each rule version that has not seen it yet.

    One copy of a text leaves each scan task (partial aggregation), however many rows hold it.
    If the ledger has seen anything, the addresses are compared with it first, and a bitmap of
    the unseen ones keeps the texts of the others in the scan.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    wanted = F.array(*(F.lit(f"{r.name}@{r.version}") for r in rules))
    blobs = _addressed(df, text).select("blob", "text")
    current = F.concat_ws("@", "rule", F.col("version").cast("string"))
    known = read_ledger(spark, ledger).filter(current.isin([f"{r.name}@{r.version}" for r in rules]))
    if known.isEmpty():
        unseen = blobs.groupBy("blob").agg(F.first("text").alias("text")).withColumn("todo", wanted)
    else:
        folder = new_folder(df, "unseen")
        digests = written(blobs.select("blob").distinct(), folder, "digests")
        seen = known.join(digests, "blob", "left_semi").groupBy("blob").agg(F.collect_set(current).alias("seen"))
        todo = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
        pairs = digests.join(seen, "blob", "left").select("blob", todo.alias("todo")).filter(F.size("todo") > 0)
        pairs = written(pairs, folder, "pairs")
        code = F.xxhash64("blob")
        texts = with_maybe(blobs, code, pairs, code, BITS, MOST_BITS).filter("maybe")
        unseen = texts.groupBy("blob").agg(F.first("text").alias("text")).join(pairs, "blob")
    unseen = unseen.select("blob", "text", "todo")
    found = unseen.mapInArrow(_scan(tuple(rules)), LEDGER)
    found.write.mode("append").partitionBy("rule", "version").parquet(ledger)


def _addressed(df: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(column(text), F.lit(""))
    return packed(df, text=t, blob=F.unhex(F.sha2(t, 256)))


def scan_secrets(df: DataFrame, ledger: str, text: str = "text", rules=RULES) -> DataFrame:
    """Rows of ``df`` with ``findings``: array of (kind, start, end) by start, then rule order.

    Positions are code points, ends exclusive. A null text counts as empty and has no
    findings; repeated rows each get theirs; an empty table stays empty and writes nothing
    to the ledger. A column named ``findings`` in ``df`` is replaced.
    """
    update_ledger(df, ledger, text, rules)
    rank = F.array_position(F.array(*(F.lit(r.name) for r in rules)), F.col("rule"))
    current = F.concat_ws("@", "rule", F.col("version").cast("string"))
    found = (
        read_ledger(df.sparkSession, ledger)
        .filter(current.isin([f"{r.name}@{r.version}" for r in rules]))
        .filter(F.size("spans") > 0)
        .select(
            "blob",
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"), rank.alias("rank"), s["end"].alias("end"),
                    F.col("rule").alias("kind"),
                ),
            ).alias("spans"),
        )
        .groupBy("blob")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    )
    # A plain table and not an aggregate: Spark can then split the rows of a much copied blob.
    found = written(found, new_folder(df, "findings"), "by-blob")
    findings = F.transform(
        F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    rows = _addressed(df, text).drop("text").join(found, "blob", "left")
    return unpacked(rows.withColumn("findings", findings), "findings")
