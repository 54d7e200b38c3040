"""Periodic runs of words, by seeds that are extended along diagonals.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal), at
least ``max(12, 2 q)`` words long, that no neighbouring word extends. Where words ``q``
apart are equal, the text matches itself along the diagonal of lag ``q``; the match of a run
is ``length - q`` words long, so at least 6, and at least ``q``.

1. Index. The least match of lags below 12 is 6, of lags from ``K`` to ``2 K`` it is ``K``,
   for ``K`` = 12, 24, 48 ... So 6-grams and ``K``-grams are ranked, each only at positions
   whose half as long gram recurs in the same text: prose leaves next to nothing.
2. Seeds. Pairs of occurrences of one gram in one text whose lag is in the gram's range.
3. Furthest covered positions. A diagonal's pairs that lie in one match are covered by the
   extension of its first. The table of what is covered, per lag, comes down to a test of
   the left neighbours: where these agree, an earlier pair of that lag covers this one.
   Occurrences are grouped by left neighbour, so covered pairs are skipped in blocks and
   never listed. What is left are the starts of all long matches, and there are not more of
   them than a small multiple of the words (matches whose lag is below twice their length).
4. Extension to the right by the ranked grams, from long to short: a logarithmic number of
   steps whatever the length.
5. A stretch found with several lags has the smallest as its period.

All texts of an Arrow batch are worked on together, some 200,000 words at a time, in numpy.
Nothing is shuffled. A task holds one such block or one text, whichever is longer: about 100
bytes a word, and 4 more for each gram length up to the longest that recurs.

Edge cases: a null or empty text has no words, no runs and the collapsed text "". Words
compare as bytes. Repeated rows give repeated results; a null ``doc_id`` is kept; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tessera.llm.common import pick

GRAM = 6                          # words that any run's match has at least
MIN_LENGTH = 2 * GRAM             # words of a run at least
BLOCK_WORDS = 200_000             # words worked on together, if no single text is longer


def _recurring(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and the ranks of those."""
    _, rank, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = times[rank] > 1
    return again, rank[again]


def _index(codes: np.ndarray, text: np.ndarray, longest: int) -> list[tuple[int, np.ndarray]]:
    """``(K, rank by position)`` for K = 6, 12, 24 ...; equal ranks are equal K-grams of one
    text, -1 stands where a gram does not recur in its text."""
    n = len(codes)
    whole = np.flatnonzero(text[:n - GRAM + 1] == text[GRAM - 1:]) if n >= GRAM else np.empty(0, int)
    mixed = text[whole].astype(np.uint64)
    for t in range(GRAM):                       # equal grams have equal sums: a first sieve
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[whole + t].astype(np.uint64) + np.uint64(1)
    at = whole[_recurring(mixed)[0]]
    rank = text[at].astype(np.int64)
    for t in range(GRAM):
        rank = np.unique(rank * (codes.max(initial=0) + 1) + codes[at + t], return_inverse=True)[1]
    again, rank = _recurring(rank)
    at, size, levels = at[again], GRAM, []
    while len(at):
        ranks = np.full(n + 1, -1, np.int32)
        ranks[at] = rank
        levels.append((size, ranks))
        if 2 * size > longest // 2:
            break
        at = at[at + size < n]
        at = at[ranks[at + size] >= 0]
        again, rank = _recurring(ranks[at].astype(np.int64) * (n + 1) + ranks[at + size])
        at, size = at[again], 2 * size
    return levels


def _seeds(ranks: np.ndarray, left: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and lags of the pairs of equal grams with ``low <= lag < high`` whose left
    neighbours differ."""
    at = np.flatnonzero(ranks >= 0)
    at = at[np.argsort(ranks[at], kind="stable")]
    group, before = ranks[at].astype(np.int64), left[at]
    edge = np.append(np.flatnonzero((group[1:] != group[:-1]) | (before[1:] != before[:-1])) + 1,
                     len(at))
    block_end = edge[np.searchsorted(edge, np.arange(len(at)), side="right")]
    place = group * (len(ranks) + high) + at
    first = np.arange(len(at))
    other = np.searchsorted(place, place + low)
    stop = np.searchsorted(place, place + high)
    found = []
    while True:
        live = other < stop
        first, other, stop = first[live], other[live], stop[live]
        if not len(first):
            break
        end = np.minimum(block_end[other], stop)
        fresh = before[other] != before[first]
        count = (end - other)[fresh]
        step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        mine = at[np.repeat(first[fresh], count)]
        found.append((mine, at[np.repeat(other[fresh], count) + step] - mine))
        other = end
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return tuple(np.concatenate(x) for x in zip(*found))


def _match(codes, text, levels, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many words from ``one`` and from ``two`` on are equal within their text."""
    one, two, begin = one.copy(), two.copy(), one.copy()
    n = len(codes)
    for size, ranks in reversed(levels):
        live = np.arange(len(one))
        while len(live):                        # more than one step at the top level only
            a = ranks[one[live]]
            live = live[(a >= 0) & (a == ranks[two[live]])]
            one[live] += size
            two[live] += size
    live = np.arange(len(one))
    for _ in range(GRAM - 1):
        live = live[two[live] < n]
        a, b = one[live], two[live]
        live = live[(codes[a] == codes[b]) & (text[a] == text[b])]
        one[live] += 1
        two[live] += 1
    return one - begin


def find_runs(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, by start and period.

    ``codes`` holds the words of one or more texts as numbers, ``text`` each word's text
    (ascending from 0); starts count over all words.
    """
    nothing = np.empty((0, 3), np.int64)
    if len(codes) < MIN_LENGTH:
        return nothing
    levels = _index(codes, text, int(np.bincount(text).max()))
    left = np.empty(len(codes) + 1, np.int64)
    left[1:] = codes
    left[np.flatnonzero(np.diff(text, prepend=-1))] = -1    # the first word of a text
    found = []
    for size, ranks in levels:
        low = 1 if size == GRAM else size
        start, lag = _seeds(ranks[:-1], left, low, 2 * size)
        match = _match(codes, text, levels, start, start + lag)
        good = match >= np.maximum(MIN_LENGTH - lag, lag)
        found.append(np.stack([start[good], (match + lag)[good], lag[good]], axis=1))
    if not found:
        return nothing
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = (runs[1:, 0] == runs[:-1, 0]) & (runs[1:, 1] == runs[:-1, 1])
    runs = runs[np.append(True, ~again)[:len(runs)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _block(texts: list[list[bytes]]) -> list[tuple[list[dict], bytes]]:
    """The runs and the collapsed text of each text."""
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64,
                        sum(map(len, texts)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    runs = find_runs(codes, np.repeat(np.arange(len(texts)), sizes))
    cut = np.searchsorted(runs[:, 0], np.append(begin, len(codes)))
    out = []
    for i, t in enumerate(texts):
        own = runs[cut[i]:cut[i + 1]]
        if len(own):
            own = own - [begin[i], 0, 0]
            depth = np.zeros(len(t) + 1, np.int64)
            np.add.at(depth, own[:, 0] + own[:, 2], 1)
            np.add.at(depth, own[:, 0] + own[:, 1], -1)
            t = [t[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
        out.append(([dict(zip(("start", "length", "period"), r)) for r in own.tolist()], b" ".join(t)))
    return out


def _worker(block_words: int):
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

        def made(ids, texts):
            done = _block(texts)
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([r for r, _ in done], kind),
                 pa.array([c for _, c in done], pa.binary()).cast(pa.string(), safe=False)],
                names=["doc_id", "n_words", "runs", "collapsed"])

        for batch in batches:
            ids, column = batch.column(0), batch.column(1).cast(pa.binary())
            texts, since, held = [], 0, 0
            for i in range(batch.num_rows):
                # bytes.split cuts at space and \t \n \v \f \r, and at nothing else
                texts.append((column[i].as_py() or b"").split())
                held += len(texts[-1])
                if held >= block_words:
                    yield made(ids.slice(since, i + 1 - since), texts)
                    texts, since, held = [], i + 1, 0
            if texts:
                yield made(ids.slice(since), texts)
    return run


def word_runs(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``.

    ``runs`` is an array of ``(start, length, period)`` by start and period, in words from 0;
    ``collapsed`` joins by one space the words that no run contains after its first period.
    """
    two = pick(docs, "doc_id", "text")
    kind = two.schema["doc_id"].dataType.simpleString()
    return two.mapInArrow(_worker(block_words), f"doc_id {kind}, n_words long, runs array<struct<"
                          "start:long,length:long,period:long>>, collapsed string")


# executors get this module's functions with the job and need not have it installed
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["x"]))
