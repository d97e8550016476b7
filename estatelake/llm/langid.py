"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams that both hold
(presence, n = 1..3 blended), over the root of the product of their own numbers.
N-grams are counted in hashed form: 2**15 places. From a bounded sample of
labelled texts the driver picks landmarks for each language, maps the sample
through them (Nystroem) and solves one ridge regression for each language
against the rest. Documents are scored in batches by two matrix products:
presence x landmarks gives the kernel values, kernel x weights the scores.

What is fitted is bounded by parameters: ``sample`` texts, of which only the
presence bits (4 KB each) come to the driver, and ``landmarks``. Every document
is scored, on its whole text, in one pass without a shuffle.

Cases: text that is null or has no letter is ``und`` with score 0; ties go to
the language that sorts first; without any labelled row, or in an empty table,
all are ``und``; a null id is never held out and no example; repeated rows are
scored each for itself, and of rows with one id all or none are examples; extra
columns travel inside ``row``, whatever their names. More than MOST_LANGS
languages raise.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelake.llm.common import table

PLACES = 1 << 15
LONGEST = 3
#: Bounds of what is fitted: labelled texts, and landmarks, over all languages.
SAMPLE = 1200
LANDMARKS = 160
MOST_LANGS = 1000
RIDGE = 1e-2
SHARPNESS = 4.0
BATCH = 128


@functools.cache
def _letters() -> np.ndarray:
    """Of the first 2**16 code points, the lower-case form if it is a letter, else a space."""
    out = np.full(1 << 16, 32, np.uint32)
    for i in range(1 << 16):
        if (c := chr(i)).isalpha():
            out[i] = ord(c.lower()[0])
    return out


def presence(text: str, row: np.ndarray) -> None:
    """Marks the places of a text's n-grams."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes < 1 << 16
    codes = _letters()[codes] if small.all() else np.where(small, _letters()[np.where(small, codes, 32)], codes)
    gram = np.zeros(len(codes), np.uint32)
    for n in range(1, min(LONGEST, len(codes)) + 1):
        gram = gram[: len(codes) - n + 1] * np.uint32(0x01000193) + (codes[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        row[mixed >> np.uint32(17)] = 1


@dataclass
class Model:
    langs: list[str]
    marks: np.ndarray  # landmarks' presence, as bits
    weights: np.ndarray  # landmarks x languages

    def scorer(self):
        marks = np.unpackbits(self.marks, axis=1).astype(np.float32)
        own = np.sqrt(marks.sum(axis=1))
        turned = np.ascontiguousarray(marks.T)
        block = np.zeros((BATCH, PLACES), np.float32)

        def score(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Index of the best language and its score, for up to BATCH texts."""
            block[: len(texts)] = 0
            for text, row in zip(texts, block, strict=False):
                presence(text, row)
            x = block[: len(texts)]
            kernel = x @ turned / np.maximum(np.sqrt(x.sum(axis=1))[:, None] * own, 1)
            margins = (kernel @ self.weights).astype(np.float64)
            best = margins.argmax(axis=1)
            odds = np.exp(SHARPNESS * (margins - margins.max(axis=1)[:, None]))
            return best, 1 / odds.sum(axis=1)

        return score


def fit(bits: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> Model:
    """bits: presence of the sample's texts, packed; rows in a fixed order."""
    langs = sorted(set(labels))
    at = {x: np.array([i for i, y in enumerate(labels) if y == x]) for x in langs}
    each = max(1, landmarks // len(langs))
    picked = np.concatenate([at[x][:each] for x in langs])
    x = np.unpackbits(bits, axis=1).astype(np.float32)
    norm = np.sqrt(np.maximum(x.sum(axis=1), 1))
    k_nm = (x @ x[picked].T / (norm[:, None] * norm[picked])).astype(np.float64)
    values, vectors = np.linalg.eigh(k_nm[picked])
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = k_nm @ root
    goal = np.array([[1.0 if y == lang else -1.0 for lang in langs] for y in labels])
    # Languages count alike, however many texts each has.
    share = np.array([1 / len(at[y]) for y in labels])
    share *= len(labels) / share.sum()
    w = np.linalg.solve(z.T @ (z * share[:, None]) + ridge * np.eye(z.shape[1]), z.T @ (goal * share[:, None]))
    return Model(langs, bits[picked], (root @ w).astype(np.float32))


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in batch["text"].to_pylist():
            row = np.zeros(PLACES, np.uint8)
            presence(text, row)
            out.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["lang"], pa.array(out, pa.binary())], ["doc_id", "lang", "bits"])


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Fits on at most ``sample`` labelled texts that are not held out, the same number of each language: those with the smallest hashed ids."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    ids = labelled.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    # A first cut by hash leaves about twice the sample of each language, so that no task sorts all rows of one.
    counted = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGS + 1).collect()
    if len(counted) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not counted:
        return None
    # MOST_LANGS rows at most, so that rows are dropped before any shuffle.
    rates = docs.sparkSession.createDataFrame([(r["lang"], 2.0 * sample / r["n"]) for r in counted], "of string, rate double")
    some = ids.join(F.broadcast(rates), F.col("lang") == F.col("of")).filter(F.pmod("h", F.lit(1 << 30)) < F.col("rate") * (1 << 30))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = some.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= sample).select("doc_id", "lang", "nth").orderBy("nth", "lang").limit(sample).select("doc_id").collect()
    if not picked:
        return None
    wanted = labelled.filter(F.col("doc_id").isin([r[0] for r in picked])).mapInArrow(_bits, "doc_id long, lang string, bits binary")
    rows = wanted.orderBy("doc_id", "lang", "bits").limit(sample).collect()
    rows.sort(key=lambda r: (hash_order(r["doc_id"]), r["lang"]))
    return fit(np.frombuffer(b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1), [r["lang"] for r in rows], landmarks, ridge)


def hash_order(doc_id: int) -> int:
    """A fixed shuffle of ids, so that landmarks are no run of neighbours."""
    return (doc_id * 0x9E3779B97F4A7C15) % 2**64


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        score = model.scorer() if model else None
        for batch in batches:
            texts, lettered = batch["_text"], batch["_lettered"].to_pylist()
            rows = np.flatnonzero(lettered)
            langs, scores = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            for at in range(0, len(rows), BATCH):
                own = rows[at : at + BATCH]
                best, value = score(texts.take(pa.array(own)).to_pylist())
                for i, lang in zip(own, best, strict=True):
                    langs[i] = model.langs[lang]
                scores[own] = value
            names = [x for x in batch.schema.names if not x.startswith("_")]
            yield pa.RecordBatch.from_arrays([*(batch[x] for x in names), pa.array(langs), pa.array(scores)], [*names, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", with_rows: bool = True, model: Model | None = None, **bounds) -> DataFrame:
    """Returns ``row`` (the input row, if ``with_rows``), ``doc_id``, ``held_out``, ``lang_pred`` and ``score``."""
    model = model or train(docs, id_col, text_col, lang_col, **bounds)
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)) if model else F.lit(False)
    text = F.col(text_col) if model else F.lit(None).cast("string")
    asked = docs.select(*[F.struct("*").alias("row")] * with_rows, F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.when(lettered, text).alias("_text"), lettered.alias("_lettered"))
    schema = asked.drop("_text", "_lettered").schema.add("lang_pred", "string").add("score", "double")
    return asked.mapInArrow(_predict(docs.sparkSession.sparkContext.broadcast(model)), schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), with_rows=False)
