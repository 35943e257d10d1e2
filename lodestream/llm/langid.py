"""Word-first language identification with backoff to character n-grams.

Training counts words by language with Spark aggregations, over a sample of
about ``sample_docs`` labelled documents (the bound is a parameter; where fewer
are labelled, all count).  A known word scores by its log frequency in each
language; an unseen word falls back to n-grams of 5, then 4, ... then 1
characters, using the longest that is known at each place.  N-grams are counted
from whole words, with their full counts.  The model is the most frequent words and
n-grams, bounded by parameters and each kept with all its languages, so it may be
broadcast.  Prediction covers every row without a shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.llm._common import cut_lineage, map_text, text_of

SLICE_BYTES = 4 << 20
NGRAMS = (5, 4, 3, 2, 1)
_WORD = re.compile(r"[^\W\d_]+")
KNOWN_WORDS = 300_000


@dataclass
class Model:
    """Log frequencies by language: a row of ``word_rows`` or ``gram_rows`` for each known word or n-gram."""

    langs: list[str]
    prior: np.ndarray
    words: dict[str, int]
    word_rows: np.ndarray
    grams: dict[str, int]
    gram_rows: np.ndarray

    def score(self, word: str) -> np.ndarray:
        """Log scores of one lower-case word, by language."""
        found = self.words.get(word)
        if found is not None:
            return self.word_rows[found]
        padded, parts = f"<{word}>", []
        size = len(padded)
        for at in range(size):
            for n in NGRAMS:
                row = self.grams.get(padded[at : at + n]) if at + n <= size else None
                if row is not None:
                    parts.append(row)
                    break
        return self.gram_rows[parts].mean(axis=0) if parts else np.zeros(len(self.langs))


class Scorer:
    """A model with the scores of the words met so far, kept as one table so that a text is one product."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.rows = np.zeros((1024, len(model.langs)))

    def _row(self, word: str) -> int:
        at = self.known[word] = len(self.known)
        if at == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self.model.score(word)
        return at

    def predict(self, text: str) -> tuple[str, float]:
        counts = Counter(_WORD.findall(text.lower()))
        if not self.model.langs or not any(c.isalpha() for w in counts for c in w):
            return "und", 0.0
        known = self.known
        at = [known[w] if w in known else self._row(w) for w in counts]
        total = self.model.prior + np.fromiter(counts.values(), float, len(at)) @ self.rows[at]
        odds = np.exp(total - total.max())
        best = int(total.argmax())
        return self.model.langs[best], float(odds[best] / odds.sum())

    def forget(self, most: int) -> None:
        if len(self.known) > most:
            self.known.clear()


#: The scorer of the latest model in this worker; its later tasks find their words in it.
_LATEST: dict[str, Scorer] = {}


def _scorer(key: str, shared) -> Scorer:
    if key not in _LATEST:
        _LATEST.clear()
        _LATEST[key] = Scorer(shared.value)
    return _LATEST[key]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1, F.lit(False))


def _log_table(counts: list, langs: list[str], smooth: float) -> tuple[dict[str, int], np.ndarray]:
    """Log frequencies by language from (key, {lang: count}) rows: each key's row number, and the rows."""
    place = {x: i for i, x in enumerate(langs)}
    table = np.zeros((len(counts), len(langs)))
    for row, (_, by_lang) in enumerate(counts):
        for lang, n in by_lang.items():
            table[row, place[lang]] = n
    total = table.sum(axis=0) + smooth * max(len(counts), 1)
    return {key: i for i, (key, _) in enumerate(counts)}, np.log((table + smooth) / total)


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
            counts.update((lang, w) for w in _WORD.findall(text.lower()))
        return _count_rows(counts)

    yield from map_text(batches, SLICE_BYTES, work)


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All n-grams of the padded words, with the words' counts."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in part.columns), strict=True):
            padded = f"<{word}>"
            for size in NGRAMS:
                for at in range(len(padded) - size + 1):
                    counts[lang, padded[at : at + size]] += n
        return _count_rows(counts)

    yield from map_text(batches, SLICE_BYTES // 8, work)


def _count_rows(counts: Counter) -> pa.RecordBatch:
    langs, keys = zip(*counts, strict=True) if counts else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(counts.values(), pa.int64())], ["lang", "key", "n"])


def _most_frequent(counts: DataFrame, most: int, least: int) -> list[tuple[str, dict[str, int]]]:
    """The keys of the highest totals (at least ``least``), each with its counts in all languages."""
    by_key = counts.groupBy("key").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang"))
    return [(r["key"], r["by_lang"]) for r in by_key.filter(F.col("total") >= least).orderBy(F.desc("total"), "key").limit(most).collect()]


def train(df: DataFrame, sample_docs: int = 20_000, max_words: int = 60_000, max_grams: int = 60_000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on labelled rows that are not held out.

    Languages are sampled apart, so a rare one keeps its documents.  The
    ``max_words`` most frequent words of the sample that occur twice or more,
    and the ``max_grams`` most frequent n-grams that occur three times or more,
    reach the driver, and one row for each language.  Null texts hold no words;
    rows without a language are left out; repeated rows count each; an empty table gives
    an empty model; other columns are ignored.
    """
    labelled = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs, total = sorted(sizes), sum(sizes.values())
    if not total:
        return Model([], np.zeros(0), {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    shares = df.sparkSession.createDataFrame([(x, min(1.0, sample_docs / len(langs) / sizes[x])) for x in langs], "lang string, share double")
    sample = labelled.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < F.col("share") * 1_000_000)
    counted = "lang string, key string, n long"
    words = cut_lineage(sample.select("lang", text_of("text").alias("text")).mapInArrow(_count_words, counted).groupBy("lang", "key").agg(F.sum("n").alias("n")))
    grams = words.select("lang", "key", "n").mapInArrow(_count_grams, counted).groupBy("lang", "key").agg(F.sum("n").alias("n"))
    prior = np.log(np.array([sizes[x] for x in langs], float) / total)
    by_length = defaultdict(list)
    for gram, by_lang in _most_frequent(grams, max_grams, 3):
        if gram not in ("<", ">"):
            by_length[len(gram)].append((gram, by_lang))
    # Each length has frequencies of its own.
    index: dict[str, int] = {}
    gram_rows = [np.zeros((0, len(langs)))]
    for rows in by_length.values():
        places, table = _log_table(rows, langs, 0.5)
        index.update({gram: len(index) + i for gram, i in places.items()})
        gram_rows.append(table)
    return Model(langs, prior, *_log_table(_most_frequent(words, max_words, 2), langs, 0.5), index, np.concatenate(gram_rows))


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score (the posterior of the predicted language).

    Null texts, texts without a letter, and any text under an empty model are
    'und' with score 0.  Repeated rows are predicted alike; an empty table
    gives no rows; other columns are ignored.
    """
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            scorer.forget(KNOWN_WORDS)
            found = [scorer.predict(x) for x in part.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

        yield from map_text(batches, SLICE_BYTES, work)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
