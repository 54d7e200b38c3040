"""Language identification by language-bitmask n-gram filters.

Training counts character n-grams per language in Spark. The n-grams that make up at
least ``MIN_SHARE`` of a language go into a bit-sliced Bloom filter: a table of
bitmasks, one bit per language. The AND of the masks at an n-gram's ``HASHES`` places
has the bits of all languages that hold the n-gram, so one lookup asks every language.

A text's n-grams are looked up, the set bits are counted per language and corrected for
the false positives that the fill of the language's slice lets expect. The language with
the largest corrected count wins (the first by name among equals); ``score`` is its
corrected share of the n-grams.

An n-gram is a window of ``N`` characters over lower-cased letters, every run of other
characters read as one blank; texts are read whole.

Edge cases: a text that is null or has no letter is ``und`` with score 0, so is every
text when there is no labelled row; rows with a null language do not train; a language
of which no n-gram is frequent enough is never predicted; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pick, written

N = 4
HASHES = 4
MIN_SHARE = 2e-5        # so a language has at most 50,000 n-grams in the filter
BITS_PER_GRAM = 24
UNKNOWN = "und"
SLICE = 1 << 20         # characters handled at a time

_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """The rows that do not train: crc32 of the id as text leaves 2 modulo 4."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _letter_table() -> np.ndarray:
    """Code point -> lower-case letter, or 0 for everything that is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000:
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
    return table


class _Letters:
    """The letter table, made once per Python worker."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = _letter_table()
        return cls.table


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing function (two rounds of multiply and shift)."""
    x = (x ^ np.uint64(seed)) * _MIX
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams, the text each belongs to, and each text's letters.

    Every text is framed by blanks; a window that begins with a blank run's end or ends
    with its start is kept, one with two blanks in a row cannot occur.
    """
    joined = np.frombuffer(" ".join(["", *[t or "" for t in texts], ""]).encode(
        "utf-32-le", "surrogatepass"), np.uint32)
    lens = np.array([len(t or "") + 1 for t in texts], np.int64)    # with the blank after it
    owner = np.repeat(np.arange(len(texts)), lens)
    codes = _Letters.get()[joined]
    is_letter = codes[1:] != 0
    letters = np.bincount(owner[is_letter], minlength=len(texts))
    keep = is_letter | (codes[:-1] != 0)                  # blanks only behind a letter
    codes, owner = codes[1:][keep].astype(np.uint64), owner[keep]
    # a blank in front of each text's first character
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    codes, owner = np.insert(codes, firsts, 0), np.insert(owner, firsts, owner[firsts])
    if len(codes) < N:
        return np.empty(0, np.uint64), np.empty(0, np.int64), letters
    h = codes[:len(codes) - N + 1].copy()
    for k in range(1, N):
        h = h * np.uint64(0x100000001B3) + codes[k:len(codes) - N + 1 + k]
    same = owner[:len(h)] == owner[N - 1:]
    return _mixed(h[same], 1), owner[:len(h)][same], letters


def _slices(lengths: list[int]) -> Iterator[tuple[int, int]]:
    lo = size = 0
    for i, n in enumerate(lengths):
        if i > lo and size + n > SLICE:
            yield lo, i
            lo, size = i, 0
        size += n
    if lengths:
        yield lo, len(lengths)


def gram_counts(rows: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` partial counts of the rows' ``lang`` and ``text``; each task adds
    up before it ships, a slice of texts at a time."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, lang = np.unique(np.array(batch.column(1).to_pylist(), object).astype(str),
                                    return_inverse=True)
            for i, name in enumerate(names):
                own = [t for t, g in zip(texts, lang) if g == i]
                parts = [np.unique(grams(own[a:b])[0], return_counts=True)
                         for a, b in _slices([len(t or "") for t in own])]
                every = np.concatenate([p[0] for p in parts])
                times = np.concatenate([p[1] for p in parts])
                order = np.argsort(every, kind="stable")
                every, times = every[order], times[order]
                first = np.flatnonzero(np.diff(every, prepend=np.uint64(0)) | (np.arange(
                    len(every)) == 0).astype(np.uint64))
                if len(every):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(first)), pa.array(every[first].view(np.int64)),
                         pa.array(np.add.reduceat(times, first))], names=["lang", "gram", "n"])

    return rows.select("text", "lang").mapInArrow(count, "lang string, gram long, n long").groupBy(
        "lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Bit-sliced Bloom filters: one row of ``ceil(languages / 64)`` words per place."""

    def __init__(self, langs: list[str], per_lang: list[np.ndarray]):
        self.langs = langs
        most = max([len(g) for g in per_lang], default=0)
        self.places = 1 << max(10, int(np.ceil(np.log2(max(1, most) * BITS_PER_GRAM))))
        self.table = np.zeros((self.places, (len(langs) + 63) // 64), np.uint64)
        for i, g in enumerate(per_lang):
            for k in range(HASHES):
                np.bitwise_or.at(self.table[:, i // 64], self._place(g, k),
                                 np.uint64(1) << np.uint64(i % 64))
        fill = [float(((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean())
                for i in range(len(langs))]
        self.false = np.array(fill) ** HASHES

    def _place(self, g: np.ndarray, k: int) -> np.ndarray:
        return (_mixed(g, 17 + k) & np.uint64(self.places - 1)).astype(np.int64)

    def masks(self, g: np.ndarray) -> np.ndarray:
        """For each n-gram the bitmask of the languages that (seem to) hold it."""
        out = self.table[self._place(g, 0)]
        for k in range(1, HASHES):
            out &= self.table[self._place(g, k)]
        return out

    def decide(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        g, owner, letters = grams(texts)
        n = np.bincount(owner, minlength=len(texts)).astype(float)
        shares = np.zeros((len(texts), len(self.langs)))
        if len(g):
            masks = self.masks(g)
            for i in range(len(self.langs)):
                bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                hits = np.bincount(owner, weights=bit.astype(float), minlength=len(texts))
                # hits = true + (n - true) * false
                shares[:, i] = (hits - n * self.false[i]) / (1 - self.false[i])
        shares /= np.maximum(n, 1)[:, None]
        known = (letters > 0) & (len(self.langs) > 0)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = shares.argmax(axis=1)
        score = np.clip(shares[np.arange(len(texts)), best], 0.0, 1.0)
        return ([self.langs[b] if ok else UNKNOWN for b, ok in zip(best, known)],
                np.where(known, score, 0.0))


def train(docs: DataFrame, min_share: float = MIN_SHARE) -> Filters:
    """Filters of all languages of the rows given (``text``, ``lang``).

    All rows are counted. At most ``1 / min_share`` n-grams per language come to the
    driver, since their shares add up to one.
    """
    counted = gram_counts(pick(docs, "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL"))
    counted = written(counted, "langid-grams")
    total = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    kept = counted.join(total, "lang").filter(F.col("n") >= F.col("total") * min_share).select(
        "lang", "gram").toArrow()
    names = np.array(kept.column("lang").to_pylist(), object)
    gram = kept.column("gram").to_numpy().view(np.uint64) if len(kept) else np.empty(0, np.uint64)
    langs = sorted(set(names))
    return Filters(langs, [np.unique(gram[names == x]) for x in langs])


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; reads nothing of a row but its text."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in _slices([len(t or "") for t in texts]):
                lang, score = shared.value.decide(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                     pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"])

    rows = pick(docs, "doc_id", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Trains on the rows that are not held out and predicts every row."""
    known = pick(docs, "doc_id", "text", "lang")
    return predict(docs, train(known.filter(~held_out(F.col("doc_id")))))
