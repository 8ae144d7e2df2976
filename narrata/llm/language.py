"""Language identification: the family first, then languages of one family against each other.

A text is lower-cased, all but letters become blanks, and its 2- and 3-byte sequences are counted over
the whole text in hashed columns. Linear support vector machines tell the families apart (one against
the rest), then one machine for every two languages of a family votes within it.

The machines are fitted on at most ``max_rows`` labelled texts, evenly over the languages: the hashes of a
language's texts are dealt into as many cells as it may have rows, and each cell gives its smallest hash. So
copies count once, every language keeps some, and no more than the bound comes to the driver, as sparse counts.
Of more than ``max_rows`` / 2 languages the most frequent ones are learned. Everything else sees every document:
languages are counted over the table, and every text is read whole for its prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows without a label are not
learned from; without any label all is ``und``; with one language all else is that language; repeated
rows are predicted alike; an empty table gives an empty result. Further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = 4096
MAX_ROWS = 3000
UNKNOWN = "und"
#: Languages by family, as ISO 639-1 codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tt tk",
    "indo-aryan": "hi ur bn mr gu pa ne si",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "malayic": "id ms",
}
_not_letters = re.compile(r"[\W\d_]+")


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0]
    return next((family for family, codes in FAMILIES.items() if code in codes.split()), code)


def sequence_counts(text: str | None) -> np.ndarray:
    """The hashed counts of a text's byte sequences."""
    data = (" " + _not_letters.sub(" ", (text or "").lower()).strip() + " ").encode("utf-8", "replace")
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(COLUMNS, np.int64)
    pairs = (b[:-1] << 8) | b[1:]
    triples = (pairs[:-1] << 8) | b[2:]
    hashed = np.concatenate([pairs * np.uint32(2654435761), (triples + np.uint32(1 << 24)) * np.uint32(2246822519)])
    return np.bincount(hashed >> np.uint32(20), minlength=COLUMNS)


def _sparse(counts: np.ndarray) -> tuple[bytes, bytes]:
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes(), counts[at].astype(np.uint32).tobytes()


def unit_rows(counts: np.ndarray) -> np.ndarray:
    """Square roots of counts, in rows of unit length; works in place."""
    np.sqrt(counts, out=counts)
    counts /= np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)
    return counts


def features(texts: list[str | None]) -> np.ndarray:
    """One row of unit length for each text."""
    out = np.zeros((len(texts), COLUMNS), np.float32)
    for row, text in enumerate(texts):
        out[row] = sequence_counts(text)
    return unit_rows(out)


def fit_machines(x: np.ndarray, targets: np.ndarray, penalty: float = 1e-3, steps: int = 250) -> np.ndarray:
    """Linear machines with squared hinge loss; a column of ``targets`` (1, -1, 0: not used) each.

    Accelerated gradient descent. Rows are weighted so that both sides of a machine count alike.
    """
    weight = np.zeros(targets.shape, np.float32)
    for side in (1, -1):
        weight += (targets == side) / np.maximum(2 * (targets == side).sum(axis=0), 1)
    w = v = np.zeros((x.shape[1] + 1, targets.shape[1]), np.float32)  # the last row is the offset
    for step in range(steps):
        slack = np.maximum(0, 1 - targets * (x @ v[:-1] + v[-1])) * (targets != 0)
        pull = slack * targets * weight
        gradient = -2 * np.vstack([x.T @ pull, pull.sum(axis=0)]) + penalty * v
        new = v - gradient / (4 + penalty)
        v = new + step / (step + 3) * (new - w)
        w = new
    return w


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        labels = np.array(langs)
        self.families = sorted({family_of(lang) for lang in self.langs})
        self.members = {f: [lang for lang in self.langs if family_of(lang) == f] for f in self.families}
        self.pairs = [pair for f in self.families for pair in combinations(self.members[f], 2)]
        of = np.array([family_of(lang) for lang in langs])
        columns = [np.where(of == f, 1, -1) for f in self.families] if len(self.families) > 1 else []
        columns += [np.where(labels == a, 1, np.where(labels == b, -1, 0)) for a, b in self.pairs]
        self.weights = fit_machines(x, np.stack(columns, axis=1).astype(np.float32)) if columns else None

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score (0 to 1) of each row."""
        if self.weights is None:
            return self.langs * len(x), np.ones(len(x))
        margins = x @ self.weights[:-1] + self.weights[-1]
        sure = 1 / (1 + np.exp(-4 * margins.astype(np.float64)))
        n = len(self.families) if len(self.families) > 1 else 0
        family = np.argmax(margins[:, :n], axis=1) if n else np.zeros(len(x), int)
        score = sure[np.arange(len(x)), family] if n else np.ones(len(x))
        found = []
        for row, f in enumerate(family):
            members = self.members[self.families[f]]
            wins = {lang: (0, 0.0) for lang in members}
            for column, (a, b) in enumerate(self.pairs, n):
                if a in wins:
                    margin = float(margins[row, column])
                    winner, loser = (a, b) if margin >= 0 else (b, a)
                    wins[winner] = (wins[winner][0] + 1, wins[winner][1] + abs(margin))
                    wins[loser] = (wins[loser][0], wins[loser][1] - abs(margin))
            best = max(members, key=lambda lang: wins[lang])
            for column, (a, b) in enumerate(self.pairs, n):
                if best in (a, b):
                    score[row] *= sure[row, column] if best == a else 1 - sure[row, column]
            found.append(best)
        return found, score


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def drawn(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(lang, text) of at most ``max_rows`` different labelled texts that are not held out, evenly over the languages."""
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    labelled = labelled.select("lang", "text", F.xxhash64(F.lit("fit"), "text").alias("hash"))
    langs = [r["lang"] for r in labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max(1, max_rows // 2)).collect()]
    if not langs:
        return labelled.select("lang", "text").limit(0)
    cell = F.pmod("hash", F.lit(max_rows // len(langs)))
    picked = labelled.filter(F.col("lang").isin(langs)).groupBy("lang", cell.alias("cell")).agg(F.min("hash").alias("hash"))
    rows = labelled.join(F.broadcast(picked.drop("cell")), ["lang", "hash"])  # at most max_rows pairs
    return rows.groupBy("lang", "hash").agg(F.min("text").alias("text")).orderBy("lang", "hash").select("lang", "text")


def fit(docs: DataFrame, max_rows: int = MAX_ROWS) -> LanguageModel | None:
    """Learn from the documents with a label that are not held out; None when there are none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sparse = [_sparse(sequence_counts(text.as_py())) for text in batch.column("text")]
            columns = list(zip(*sparse, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), *(pa.array(c, pa.binary()) for c in columns)], ["lang", "at", "counts"])

    rows = drawn(docs, max_rows).mapInArrow(counted, "lang string, at binary, counts binary").toArrow()
    if not rows.num_rows:
        return None
    x = np.zeros((rows.num_rows, COLUMNS), np.float32)
    for row, (at, counts) in enumerate(zip(rows["at"], rows["counts"], strict=True)):
        x[row, np.frombuffer(at.as_buffer(), np.uint16)] = np.frombuffer(counts.as_buffer(), np.uint32)
    return LanguageModel(unit_rows(x), rows["lang"].to_pylist())


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None) -> DataFrame:
    """Add lang_pred and score to the columns ``keep`` (default doc_id), computed from the text alone."""
    keep = keep or ["doc_id"]
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    text = f"keep_{keep.index('text')}" if "text" in keep else "text"  # a kept text is handed over once
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, *(["text"] if text == "text" else []), has_letter.alias("has_letter"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                lettered = part.column("has_letter").to_pylist()
                if model is None:
                    langs, scores = [UNKNOWN] * len(lettered), [0.0] * len(lettered)
                else:
                    langs, scores = model.predict(features(part.column(text).to_pylist()))
                    langs = [lang if ok else UNKNOWN for lang, ok in zip(langs, lettered, strict=True)]
                    scores = [float(s) if ok else 0.0 for s, ok in zip(scores, lettered, strict=True)]
                columns = [part.column(f"keep_{i}") for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    [*(f"keep_{i}" for i in range(len(keep))), "lang_pred", "score"],
                )

    kinds = [f"keep_{i} {rows.schema[f'keep_{i}'].dataType.simpleString()}" for i in range(len(keep))]
    out = rows.mapInArrow(predicted, ", ".join([*kinds, "lang_pred string", "score double"]))
    return out.select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score")


def identify(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Return doc_id, held_out, lang_pred, score for every document."""
    return predict(docs, fit(docs, max_rows)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, min_score: float, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents, with all their columns, whose language is found with at least ``min_score``."""
    columns = docs.columns
    numbered = predict(docs, fit(docs, max_rows), columns).toDF(*[f"c{i}" for i in range(len(columns) + 2)])
    kept = numbered.filter((F.col(f"c{len(columns)}") != UNKNOWN) & (F.col(f"c{len(columns) + 1}") >= min_score))
    return kept.select(*[f"c{i}" for i in range(len(columns))]).toDF(*columns)
