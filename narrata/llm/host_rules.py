"""Quality rules judged by host.

Every document is measured over its whole text. The rules failed are counted by host, each host's
failure rate is shrunk towards the rate of all hosts with a beta prior fitted to the hosts' own
rates (by moments), and a host whose shrunk rate of a rule is above the limit is rejected. A
document stays when it passes the base rules and its host is not rejected.

Only counts are shuffled. A hot host is counted in part by every task; the verdicts of the hosts go
back by a join that Spark may split where one host holds many rows.

Defined cases: a null text has no words and fails the base rules; a null host is a host of its own;
repeated rows are judged alike and all count; an empty table gives an empty result. The input may
have any further columns; only doc_id, text and the host column are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrata.llm.common import WORD, staged

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
BASE_RULES = {"few_words": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words"}
#: Rules that only count against the host.
HOST_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
    "dup_lines": "n_dup_lines >= 3 and 10 * n_dup_lines > n_words",
}

_words = re.compile(WORD).findall
_drop = str.maketrans("", "", SYMBOLS)


def text_measures(text: str | None, width: int = 5) -> tuple[int, int, int, int, int]:
    """The measures of one text, in the order of ``MEASURES``."""
    if not text:
        return 0, 0, 0, 0, 0
    words = _words(text)
    symbols = len(text) - len(text.translate(_drop))
    lines = [line for line in text.split("\n") if _words(line)] if "\n" in text else []
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, covered = Counter(windows), 0
        for start, window in enumerate(windows):
            if seen[window] > 1:
                repeated += start + width - max(start, covered)
                covered = start + width
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_measures(text.as_py()) for text in batch.column("text")]
        columns = [pa.array(column, pa.int64()) for column in (zip(*found, strict=True) if found else [[]] * 5)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *MEASURES])


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of every document."""
    docs = docs.select("doc_id", F.col(host).alias("host"), "text")
    ids, hosts = docs.schema["doc_id"].dataType.simpleString(), docs.schema["host"].dataType.simpleString()
    return docs.mapInArrow(_measured, f"doc_id {ids}, host {hosts}, " + ", ".join(f"{m} long" for m in MEASURES))


def host_verdicts(measured: DataFrame, max_rate: float = 0.5, most_prior: float = 1e4) -> DataFrame:
    """host_key, host_docs and host_rejected of every host in ``measured``."""
    rules = BASE_RULES | HOST_RULES
    hosts = measured.groupBy(_key("host").alias("host_key")).agg(
        F.count("*").alias("host_docs"), *[F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in rules.items()]
    )
    rates = [F.col(name) / F.col("host_docs") for name in rules]
    # One row of moments over the hosts.
    moments = hosts.agg(
        *[F.avg(rate).alias(f"{n}_mean") for n, rate in zip(rules, rates, strict=True)],
        *[F.var_samp(rate).alias(f"{n}_var") for n, rate in zip(rules, rates, strict=True)],
    ).first()
    rejected = F.lit(False)
    for name in rules:
        mean, var = moments[f"{name}_mean"] or 0.0, moments[f"{name}_var"] or 0.0
        strength = min(max(mean * (1 - mean) / var - 1, 1.0), most_prior) if var > 0 else most_prior
        rate = (F.col(name) + mean * strength) / (F.col("host_docs") + strength)
        rejected = rejected | (rate > max_rate)
    return hosts.select("host_key", "host_docs", *rules, rejected.alias("host_rejected"))


def _key(column: str):
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def judge(docs: DataFrame, host: str = "source", max_rate: float = 0.5) -> DataFrame:
    """doc_id, the measures, base_failed, kept, and the host's counts for every document."""
    measured = staged(measures(docs, host), "host-measures")
    verdicts = host_verdicts(measured, max_rate)
    failed = F.expr(" or ".join(f"({rule})" for rule in BASE_RULES.values()))
    return (
        measured.withColumn("host_key", _key("host"))
        .join(verdicts, "host_key")
        .select(
            "doc_id", *[F.col(m) for m in MEASURES], failed.alias("base_failed"),
            (~failed & ~F.col("host_rejected")).alias("kept"), "host_docs", "host_rejected",
        )
    )
