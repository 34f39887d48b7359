"""Secret scans over a ledger of content-addressed blobs."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscorpus.llm.common import named, texts

FINDINGS = "array<struct<start:int,ord:int,kind:string,end:int>>"
LEDGER = f"blob string, rules array<string>, findings {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """One kind of secret.  ``needs``: a match holds one of these strings."""

    kind: str
    pattern: str
    needs: tuple[str, ...] = ()
    group: int = 0
    at_least: int = 0

    @property
    def version(self) -> str:
        made_of = repr((self.pattern, self.group, self.at_least))
        return f"{self.kind}@{hashlib.sha256(made_of.encode()).hexdigest()[:12]}"

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        if self.needs and not any(n in text for n in self.needs):
            return
        for m in re.finditer(self.pattern, text, re.ASCII):
            if m.end(self.group) - m.start(self.group) >= self.at_least:
                yield m.span()


#: Rules in the order in which kinds are listed; the first three are the base.
RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
        needs=(":", "="),
        group=2,
        at_least=6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", needs=("AKIA",), at_least=20),
    Rule("hex", "[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", needs=("PRIVATE KEY",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", needs=("xox",)),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", needs=("eyJ",)),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:@/]{1,64}:[^\s:@/]{3,64}@", needs=("://",)),
)
BASE = ("assign", "access", "hex")


def blob_of(text_col: str) -> Column:
    """Content address of a text; NULL has that of the empty text."""
    return F.sha2(F.coalesce(named(text_col), F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """What has been scanned so far; None before the first commit."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{path}/commit=*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def commit(versions: DataFrame, path: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the (blob, rule version) pairs that the ledger at ``path`` lacks.

    ``versions`` holds any number of versions of any paths.  Copies meet once:
    they combine before the shuffle, so a text that fills a third of the rows
    moves once a task.  The commit is written in full or not at all; a commit
    that is repeated finds nothing to do.
    """
    spark = versions.sparkSession
    blobs = (
        versions.select(F.coalesce(named(text_col), F.lit("")).alias("text"))
        .groupBy(blob_of("text").alias("blob"))
        .agg(F.first("text").alias("text"))
    )
    now = F.array(*[F.lit(r.version) for r in rules])
    ledger = read_ledger(spark, path)
    if ledger is None:
        todo = blobs.withColumn("rules", now)
    else:
        done = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("done"))
        todo = blobs.join(done, "blob", "left").select(
            "blob", "text", F.array_except(now, F.coalesce("done", F.array().cast("array<string>"))).alias("rules")
        )
    by_version = {r.version: (k, r) for k, r in enumerate(rules)}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text, wanted in zip(batch["text"], batch["rules"]):
                found.append(
                    [
                        {"start": start, "ord": order, "kind": rule.kind, "end": end}
                        for order, rule in map(by_version.get, wanted)
                        for start, end in rule.spans(text)
                    ]
                )
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["rules"], "findings": found})

    todo.where(F.size("rules") > 0).mapInPandas(scan, LEDGER).write.parquet(
        f"{path}/commit={uuid.uuid4().hex}"
    )


def findings(
    versions: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(id, blob, findings) of every row of ``versions``, from the ledger.

    ``findings`` holds (start, ord, kind, end) of the current rules' spans by
    start, then by kind as listed; code points, end exclusive.  NULL and empty
    texts have none, repeated rows each keep their row, an empty table gives
    none.  Blobs that were never committed raise no error and have no findings.
    """
    keyed = versions.select(named(id_col).alias("id"), blob_of(text_col).alias("blob"))
    none = F.array().cast(FINDINGS)
    ledger = read_ledger(versions.sparkSession, path)
    if ledger is None:
        return keyed.withColumn("findings", none)
    # a kind's findings count if its current version was scanned in that commit
    current = F.array(*[F.lit(r.version) for r in rules])
    held = ledger.where(F.size("findings") > 0).select("blob", F.array_intersect("rules", current).alias("r"), "findings")
    held = held.select(
        "blob",
        F.filter("findings", lambda f: F.exists("r", lambda v: F.substring_index(v, "@", 1) == f["kind"])).alias("findings"),
    ).where(F.size("findings") > 0)
    held = held.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("findings")))).alias("findings"))
    return keyed.join(held, "blob", "left").select("id", "blob", F.coalesce("findings", none).alias("findings"))


def redacted(df: DataFrame, path: str, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span found in its texts replaced by ``mark``.

    Overlapping and touching spans become one mark; NULL stays NULL, texts
    without spans stay as they are, columns of any name stay.
    """
    held = findings(df, path, text_col, text_col).where(F.size("findings") > 0)
    held = held.groupBy("blob").agg(F.first("findings").alias("found"))
    rows = df.select(F.struct("*").alias("row"), named(text_col).alias("text"), blob_of(text_col).alias("of"))
    joined = rows.join(held, F.col("of") == F.col("blob"), "left")

    @F.pandas_udf("string")
    def cut(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if f is None else _replace(t, f, mark) for t, f in zip(text, found)])

    clean = cut(F.col("text"), F.col("found"))
    return joined.select(
        *[clean.alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in df.columns]
    )


def _replace(text: str, spans, mark: str) -> str:
    out, done = [], 0
    for s in sorted(spans, key=lambda f: f["start"]):
        if s["start"] > done or not out:
            out += [text[done : s["start"]], mark]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ",")
