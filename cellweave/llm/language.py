"""Language identification by word-first backoff.

A word that the model knows scores its log frequency in each language. An unseen word falls back to its character
n-grams: at each of its places the longest known n-gram that starts there scores, from five characters down to one.
A text's language has the highest sum; log frequencies are whole millionths, so sums are exact in any order.

The classifier is fitted on a bounded sample of labelled rows, ROWS of each language; the counts of its words and
n-grams are made in Spark. It keeps at most ENTRIES words and as many n-grams, the bound of its broadcast. Every
document is then scored whole, in numpy; a worker scores each distinct word once.
"""

from __future__ import annotations

import collections
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import need, slices, stored
from .words import Words, table_of, texts_in_steps

#: Rows of each language in the sample, about; words and n-grams that the model keeps, each, the commonest ones.
ROWS, ENTRIES = 1000, 1 << 18
#: Characters of the longest n-grams and words that the model knows; what is added to each count.
LONGEST, WORD_CHARS, ADDED = 5, 40, 0.5
#: Words that a worker remembers, at most.
REMEMBERED = 300_000
#: No language, as the contract names it.
UNDETERMINED = "und"
#: Bytes that part words: ASCII without letters. All other bytes may be of a letter.
GAPS = table_of((0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def words_in(raw: bytes) -> list[str]:
    """The words of a run of bytes: letters and their marks, composed and lower-cased."""
    if raw.isascii():
        return [raw.decode().lower()]
    return LETTERS.findall(unicodedata.normalize("NFC", raw.decode("utf-8", "ignore")).lower())


def grams_in(word: str) -> Iterator[str]:
    """All n-grams of a word that stands between two bounds; a bound alone is none."""
    padded = f"^{word}$"
    for i in range(len(padded)):
        for n in range(1, LONGEST + 1):
            gram = padded[i : i + n]
            if len(gram) == n and gram not in "^$":
                yield gram


@dataclass
class Model:
    """Log frequencies in millionths: names to a row of scores, one column for each language."""

    langs: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)  # rows after those of the words
    scores: np.ndarray = None

    def entries(self, word: str) -> list[int]:
        """The rows that score one word: its own, or else those of its n-grams; none where none is known."""
        at = self.words.get(word)
        if at is not None:
            return [at]
        padded, known = f"^{word}$", self.grams
        found = []
        for i in range(len(padded)):
            for n in range(min(LONGEST, len(padded) - i), 0, -1):
                at = known.get(padded[i : i + n])
                if at is not None:
                    found.append(at)
                    break
        return found


def counts_of(rows: DataFrame) -> DataFrame:
    """kind (word or gram), name, lang, n over all words of rows (lang, text), which are a bounded sample: a task keeps its counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, collections.Counter] = collections.defaultdict(collections.Counter)
        for batch in slices(batches):
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                for data, offsets, _ in texts_in_steps(batch.column(1).filter(pa.array(langs == lang)), GAPS, GAPS):
                    held = Words(data, offsets, GAPS)
                    for raw, n in zip(held.names.to_pylist(), np.bincount(held.codes).tolist()):
                        for word in words_in(raw):
                            found[lang][word] += n
        for lang, words in found.items():
            words = {w: n for w, n in words.items() if len(w) <= WORD_CHARS}
            grams: collections.Counter = collections.Counter()
            for word, n in words.items():
                for gram in grams_in(word):
                    grams[gram] += n
            for kind, table in (("word", words), ("gram", grams)):
                yield pa.record_batch([pa.array([kind] * len(table)), pa.array(list(table), pa.string()), pa.array([lang] * len(table), pa.string()), pa.array(list(table.values()), pa.int64())], ["kind", "name", "lang", "n"])

    made = rows.select("lang", "text").mapInArrow(run, "kind string, name string, lang string, n long")
    return made.groupBy("kind", "name", "lang").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, rows: int = ROWS, entries: int = ENTRIES) -> Model:
    """The model of labelled rows (key, lang, text), of which about ``rows`` of each language are drawn by a hash of key.

    key: any columns' hash (long). Words seen once are not known. Rows without a language are left out; no rows
    give a model without languages.
    """
    sizes = {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([])
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, rows / sizes[lang]))))
    drawn = labelled.where("lang is not null").where(F.pmod("key", F.lit(1 << 20)) < F.lit(1 << 20) * share[F.col("lang")])
    counts = counts_of(drawn)
    totals = counts.groupBy("kind", "name").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")).where("total > 1 or kind = 'gram'")
    totals = stored(totals, "counts")
    model, held = Model(langs), []
    for kind in ("word", "gram"):
        table = totals.where(F.col("kind") == kind).orderBy(F.desc("total"), "name").limit(entries).select("name", F.array(*(F.coalesce(F.col("by")[lang], F.lit(0)) for lang in langs)).alias("n")).toArrow()
        names = table["name"].to_pylist()
        n = table["n"].combine_chunks().flatten().to_numpy().reshape(-1, len(langs)).astype(float)
        lengths = np.array([len(x) for x in names]) if kind == "gram" else np.zeros(len(names), int)
        for length in np.unique(lengths):
            mine = lengths == length
            n[mine] = np.log((n[mine] + ADDED) / (n[mine].sum(axis=0) + ADDED * mine.sum()))
        setattr(model, f"{kind}s", {x: i + sum(map(len, held)) for i, x in enumerate(names)})
        held.append(np.rint(1e6 * n).astype(np.int64))
    model.scores = np.concatenate(held)
    return model


class Scorer:
    """Sums of a model's scores over texts; the scores of distinct runs of bytes are remembered."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.scores = np.zeros((0, len(model.langs) + 1), np.int64)

    def rows_of(self, names: list[bytes]) -> np.ndarray:
        """Each run's row of self.scores: one column for each language, then its number of words."""
        if len(self.known) + len(names) > REMEMBERED:
            self.known, self.scores = {}, self.scores[:0]
        known, flat, sizes, counts = self.known, [], [], []
        for raw in names:
            if raw not in known:
                known[raw] = len(known)
                words = words_in(raw)
                found = [x for w in words for x in self.model.entries(w)]
                flat += found
                sizes.append(len(found))
                counts.append(len(words))
        if sizes:
            run = np.zeros((len(flat) + 1, len(self.model.langs)), np.int64)
            if flat:
                np.cumsum(self.model.scores[flat], axis=0, out=run[1:])
            ends = np.cumsum(sizes)
            self.scores = np.r_[self.scores, np.c_[run[ends] - run[ends - sizes], counts]]
        return np.array([known[raw] for raw in names], np.int64)

    def sums(self, column: pa.Array) -> np.ndarray:
        """For each text: the sum of the scores of its words in each language, then the number of its words."""
        total = np.zeros((len(column), self.scores.shape[1]), np.int64)
        for data, offsets, _ in texts_in_steps(column, GAPS, GAPS):
            held = Words(data, offsets, GAPS)
            row = self.rows_of(held.names.to_pylist())[held.codes] if len(held.codes) else np.zeros(0, np.int64)
            for j in range(total.shape[1]):
                run = np.r_[0, np.cumsum(self.scores[row, j])]
                total[:, j] += run[held.first[1:]] - run[held.first[:-1]]
        return total


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (the share of the best language, all being as likely before, 0 to 1).

    Null texts, texts without a letter, and all texts of a model without languages are ``und`` with score 0. Among equal
    sums the first language counts. Long texts are scored whole, in steps. Columns of these names are not allowed.
    """
    need(docs, text)
    held = docs.sparkSession.sparkContext.broadcast(model)
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        langs = np.array([*held.value.langs, UNDETERMINED], object)
        for batch in slices(batches, at):
            sums = scorer.sums(batch.column(at))
            best, score = np.full(len(sums), len(langs) - 1), np.zeros(len(sums))
            if len(langs) > 1:
                mine = np.flatnonzero(sums[:, -1] > 0)
                by = sums[mine, :-1]
                best[mine] = by.argmax(axis=1)
                score[mine] = np.round(1 / np.exp((by - by.max(axis=1, keepdims=True)) / 1e6).sum(axis=1), 6)
            yield pa.record_batch([*batch.columns, pa.array(langs[best], pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 5, rows: int = ROWS, entries: int = ENTRIES) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs.

    Rows whose crc32 of doc_id, as text, leaves no rest by ``folds`` are held out; the model is fitted on the others with a
    language. A null doc_id is neither: its held_out is null and nothing is learned from it. Repeated rows count each;
    other columns are ignored; an empty table gives no rows.
    """
    need(docs, doc_id, text, lang)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rest = F.crc32(F.col("doc_id").cast("string")) % folds
    model = fit(plain.where(rest != 0).select(F.xxhash64("doc_id").alias("key"), "lang", "text"), rows, entries)
    return predict(plain.select("doc_id", (rest == 0).alias("held_out"), "text"), model).drop("text")
