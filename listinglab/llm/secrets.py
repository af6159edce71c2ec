"""Operator 8: secret scans with an incremental blob ledger.

Every text is a blob, addressed by its SHA-256. A blob is scanned once for
each version of the rules, whatever number of paths (documents, historical
versions, sources) hold it: the ledger is a folder of findings with one row
for each scanned pair of blob and rule version, also where nothing was found.
A run takes the blobs of its paths, leaves out the pairs that the ledger
already has, scans the rest, appends their rows and joins findings back to
all paths.

Plan. Distinct blobs come from a group-by on address and bytes, so equal
addresses of different bytes would show, and copies are combined before the
shuffle: a group of copies with a third of all rows is one row per task. A
ledger with rows is first anti-joined by address, small rows on either side.
Findings are joined back by address, from written tables: Spark broadcasts the
smaller or splits a hot address as a skewed join. A run writes its ledger rows
in a folder of its own; one that dies leaves a folder without Spark's _SUCCESS
mark, which later runs ignore, and scans the same blobs again.

Rules (``RULES``) are regular expressions on UTF-8 bytes; positions are code
points, ends exclusive. The base kinds are assign, access and hex; the others
add spans and change nothing for the base ones.

Edge cases. A null text counts as empty, which has a blob of its own. Rows
with a null id and repeated rows each get their row. An empty table scans
nothing. Other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listinglab.llm.common import BATCH_ROWS, save, ship, slices, texts
from listinglab.session import work_path


class Rule(NamedTuple):
    kind: str
    pattern: re.Pattern[bytes]
    least: int = 0
    group: int = 0
    #: Lower-case byte strings of which a match must hold one; none: always search.
    hints: tuple[bytes, ...] = ()


# The patterns, the order of kinds and the least lengths. Version 1.
BASE = ("assign", "access", "hex")
RULES = (
    Rule("assign", re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I),
         12, 2, (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")),
    Rule("access", re.compile(rb"AKIA[A-Z0-9]+"), 18, 0, (b"akia",)),
    # The runs of 16 and more among the runs of [0-9a-f]+: the same matches.
    Rule("hex", re.compile(rb"[0-9a-f]{16,}"), 16),
    Rule("pem", re.compile(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 0, (b"private key-----",)),
    Rule("jwt", re.compile(rb"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 0, (b"eyj",)),
    Rule("pat", re.compile(rb"gh[pousr]_[A-Za-z0-9]{36,}"), 0, 0, (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")),
)
RULE_VERSION = 1

_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
LEDGER = T.StructType([T.StructField("blob", T.StringType()), T.StructField("rule_version", T.IntegerType()),
                       T.StructField("spans", T.ArrayType(_SPAN))])


def find(body: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then in the rules' order; code points, end exclusive."""
    folded = body.lower()
    found = []
    for order, rule in enumerate(rules):
        if rule.hints and not any(h in folded for h in rule.hints):
            continue
        for m in rule.pattern.finditer(body):
            a, b = m.span(rule.group)
            if b - a >= rule.least:
                found.append((m.start(), order, m.end()))
    if not found:
        return []
    found.sort()
    # Code points up to each byte offset, counted once from left to right.
    points, last, count = {}, 0, 0
    for offset in sorted({x for a, _, b in found for x in (a, b)}):
        count += len(body[last:offset].decode("utf-8", "replace"))
        points[offset], last = count, offset
    return [(rules[k].kind, points[a], points[b]) for a, k, b in found]


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, version: int = RULE_VERSION) -> DataFrame:
    """From (blob, body), ledger rows."""
    ship(blobs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in slices(batches, BATCH_ROWS):
            spans = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in find(b, rules)] for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), pa.array([version] * len(spans), pa.int32()), pa.array(spans, kind)], names=LEDGER.fieldNames())

    return blobs.select("blob", "body").mapInArrow(run, LEDGER)


def _ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all runs that ended well, or None before the first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, "run-*/_SUCCESS")) or []
    runs = [str(x.getPath().getParent()) for x in done]
    return spark.read.schema(LEDGER).parquet(*runs) if runs else None


def scan_paths(docs: DataFrame, ledger: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               rules: tuple[Rule, ...] = RULES, version: int = RULE_VERSION) -> DataFrame:
    """Per path: doc_id, blob, spans (kind, start, end). ``ledger``: its folder, a fresh one if None."""
    spark = docs.sparkSession
    ledger = ledger or work_path(spark, "llm-blob-ledger")
    source = texts(docs, id_col, text_col)
    addressed = source.withColumn("blob", F.sha2("body", 256))
    blobs = addressed.select("blob", "body")
    if (known := _ledger(spark, ledger)) is not None:
        seen = known.where(F.col("rule_version") == version).select("blob").distinct()
        unseen = save(blobs.select("blob").distinct().join(seen, "blob", "left_anti"), "unseen-blobs")
        blobs = blobs.join(unseen, "blob", "left_semi")
    fresh = blobs.groupBy("blob", "body").agg(F.count(F.lit(1)).alias("paths"))
    scan_blobs(fresh, rules, version).write.parquet(f"{ledger}/run-{uuid.uuid4().hex}")
    findings = _ledger(spark, ledger).where(F.col("rule_version") == version).where(F.size("spans") > 0).select("blob", "spans")
    paths = save(addressed.select("doc_id", "blob"), "blob-paths")
    none = F.array().cast(T.ArrayType(_SPAN))
    return paths.join(findings, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Per path: doc_id, counts of the base kinds, hash of the base spans, all spans as text."""
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[number(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
