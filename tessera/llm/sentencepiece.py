"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary (pieces, their scores, byte pieces) is read from a public model file. The
installed one is a BPE model: its scores are negative merge ranks, no log-likelihoods, so
the ids are neither the model's own nor those of a unigram likelihood (see the README).
A text is put in marker form: one marker in front, every space a marker. Its best
segmentation maximises the sum of the scores of its pieces; a character that no piece
covers is spelled in byte pieces. No piece has a marker or a line break behind another
character, so a text falls into chunks that can be segmented on their own, and equal
chunks are segmented once.

A task keeps at most ``MAX_CHUNKS`` segmented chunks and works on ``SLICE`` characters of
text at a time, so its memory is bounded whatever the texts are.

Edge cases: null and empty texts have no pieces and decode to themselves; a marker
character in a text is spelled in bytes, so decoding gives every text back exactly; lone
surrogates cannot occur in Spark strings; equal rows are encoded one by one; an empty
table gives an empty result; other columns are ignored by the query and kept by
``encode`` when listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import pick

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_CHUNKS = 400_000
SLICE = 2_000_000
LONG = 96               # bytes; longer chunks are segmented one by one


@dataclass
class Vocabulary:
    """Pieces as UTF-8, scores, and the ids of the 256 byte pieces."""

    pieces: list[bytes]
    scores: np.ndarray
    normal: np.ndarray
    byte_ids: np.ndarray

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        n = p.get_piece_size()
        text = [p.id_to_piece(i) for i in range(n)]
        normal = np.array([not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i)
                                or p.is_unused(i)) for i in range(n)])
        byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if p.is_byte(i):
                byte_ids[int(text[i][3:5], 16)] = i
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces")
        inner = re.compile(f"[^{MARK}][{MARK}\n]|\n.")
        if any(inner.search(t) for t, ok in zip(text, normal) if ok):
            raise ValueError("a piece holds a marker or a line break behind another character")
        return Vocabulary([t.encode() for t in text], np.array([p.get_score(i) for i in range(n)]),
                          normal, byte_ids)


class DoubleArray:
    """Trie of byte strings: the child of state s by byte c is base[s]+c if check says s."""

    def __init__(self, keys: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for key, v in keys.items():
            s = 0
            for c in key:
                if c not in children[s]:
                    children[s][c] = len(children)
                    children.append({})
                    value.append(-1)
                s = children[s][c]
            value[s] = v
        size = 2 * len(children) + 1024
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.value = np.full(size, -1, np.int64)
        self.check[0] = -2
        used = np.zeros(size, bool)
        used[0] = True
        free, todo = 1, [(0, 0)]
        while todo:
            node, at = todo.pop()
            self.value[at] = value[node]
            kids = sorted(children[node])
            if not kids:
                continue
            while used[free]:
                free += 1
            codes = np.array(kids) + 1                  # code 0 stays free: base is never a child
            b = max(1, free - int(codes[0]))
            window = 64
            while True:                                 # the first place where all children fit
                if b + window + 300 >= len(used):
                    grow = len(used)
                    used = np.concatenate([used, np.zeros(grow, bool)])
                    for name, fill in (("base", 0), ("check", -1), ("value", -1)):
                        setattr(self, name, np.concatenate(
                            [getattr(self, name), np.full(grow, fill, np.int64)]))
                taken = used[b + codes[0]:b + codes[0] + window].copy()
                for c in codes[1:]:
                    taken |= used[b + c:b + c + window]
                if not taken.all():
                    b += int(taken.argmin())
                    break
                b, window = b + window, min(2 * window, 65536)
            self.base[at] = b
            for c in kids:
                used[b + c + 1] = True
                self.check[b + c + 1] = at
                todo.append((children[node][c], b + c + 1))
        end = int(np.flatnonzero(used).max()) + 300     # any step from a used state stays inside
        pad = max(0, end - len(self.base))
        for name, fill in (("base", 0), ("check", -1), ("value", -1)):
            a = np.concatenate([getattr(self, name), np.full(pad, fill, np.int64)])[:end]
            setattr(self, name, a.astype(np.int32))

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States reached by one byte each, and whether there is such a child."""
        to = np.minimum(self.base[state] + byte + 1, len(self.check) - 1)
        return to, self.check[to] == state


class Encoder:
    """Segments chunks and keeps what it has segmented."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        keys = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
        self.trie = DoubleArray(keys)
        self.scores = v.scores
        self.unknown = float(v.scores[v.normal].min()) - 10.0
        self.lists = None
        self.chunks = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self._clear()

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items()
                if k not in ("codes", "flat", "starts", "lens", "lists")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.lists = None
        self._clear()

    def _clear(self):
        self.codes: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)

    # -- segmentation -----------------------------------------------------------------

    def segment(self, chunk: bytes) -> list[int]:
        """The best segmentation of one chunk; -1 stands for a character without a piece."""
        if self.lists is None:
            t = self.trie
            self.lists = (t.base.tolist(), t.check.tolist(), t.value.tolist(), self.scores.tolist())
        base, check, value, scores = self.lists
        n, size = len(chunk), len(check)
        best, back, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for p in range(n):
            lead = chunk[p]
            if lead & 0xC0 == 0x80:
                continue
            here, s, k = best[p], 0, p
            end = p + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            if here + self.unknown > best[end]:
                best[end], back[end], piece[end] = here + self.unknown, p, -1
            while k < n:
                to = base[s] + chunk[k] + 1
                if to >= size or check[to] != s:
                    break
                s, k = to, k + 1
                v = value[s]
                if v >= 0 and here + scores[v] > best[k]:
                    best[k], back[k], piece[k] = here + scores[v], p, v
        out, at = [], n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out.extend(int(self.vocabulary.byte_ids[b]) for b in reversed(chunk[back[at]:at]))
            at = back[at]
        return out[::-1]

    def _segment_block(self, chunks: list[bytes]) -> list[np.ndarray]:
        """The same for many chunks at once: all of them advance byte by byte together."""
        n = len(chunks)
        lens = np.array([len(c) for c in chunks])
        width = int(lens.max())
        text = np.zeros((n, width + 1), np.int32)
        text[:, :width] = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in chunks),
                                        np.uint8).reshape(n, width)
        best = np.full((n, width + 5), -np.inf)
        back = np.zeros((n, width + 5), np.int32)
        piece = np.full((n, width + 5), -1, np.int32)
        best[:, 0] = 0.0

        def offer(rows, end, start, score, ids):
            better = score > best[rows, end]
            rows, end = rows[better], end[better] if isinstance(end, np.ndarray) else end
            best[rows, end] = score[better]
            back[rows, end] = start
            piece[rows, end] = ids[better] if isinstance(ids, np.ndarray) else ids

        for p in range(width):
            lead = text[:, p]
            rows = np.flatnonzero((lens > p) & (lead & 0xC0 != 0x80))
            if not len(rows):
                continue
            b = lead[rows]
            step = np.where(b < 0x80, 1, np.where(b < 0xE0, 2, np.where(b < 0xF0, 3, 4)))
            offer(rows, p + step, p, best[rows, p] + self.unknown, -1)
            state = np.zeros(len(rows), np.int32)
            for k in range(p, width):
                inside = lens[rows] > k
                rows, state = rows[inside], state[inside]
                to, ok = self.trie.step(state, text[rows, k])
                rows, state = rows[ok], to[ok]
                if not len(rows):
                    break
                v = self.trie.value[state]
                hit = v >= 0
                if hit.any():
                    offer(rows[hit], k + 1, p, best[rows[hit], p] + self.scores[v[hit]], v[hit])
        # walk back from the ends; one column per step
        every, at, columns, froms = np.arange(n), lens.copy(), [], []
        while (at > 0).any():
            live = at > 0
            columns.append(np.where(live, piece[every, at], -2))
            froms.append(at.copy())
            at = np.where(live, back[every, at], 0)
        ids = np.stack(columns[::-1], axis=1)
        out = [row[row != -2] for row in ids]
        for i in np.flatnonzero((ids == -1).any(axis=1)):
            out[i] = np.array(self.segment(chunks[i]), np.int32)
        return out

    def _learn(self, new: list[str]) -> None:
        """Segments chunks not met before and appends them to the kept ones."""
        raw = [w.encode() for w in new]
        got: list = [None] * len(new)
        order = sorted(range(len(new)), key=lambda i: len(raw[i]))
        short = [i for i in order if len(raw[i]) <= LONG]
        for i in order[len(short):]:
            got[i] = np.array(self.segment(raw[i]), np.int32)
        for lo in range(0, len(short), 4096):
            block = short[lo:lo + 4096]
            for i, ids in zip(block, self._segment_block([raw[i] for i in block])):
                got[i] = ids
        lens = np.array([len(g) for g in got], np.int64)
        at = len(self.flat) + np.concatenate([[0], np.cumsum(lens)[:-1]])
        self.flat = np.concatenate([self.flat, *got]).astype(np.int32)
        self.starts = np.concatenate([self.starts, at])
        self.lens = np.concatenate([self.lens, lens])

    # -- texts ------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of the texts in it."""
        if len(self.codes) > MAX_CHUNKS:        # before splitting, which registers literals
            self._clear()
        split, counts = [], []
        for t in texts:
            got = self._split(t) if t else []
            split.extend(got)
            counts.append(len(got))
        new = [w for w in dict.fromkeys(split) if w not in self.codes]
        if new:
            first = len(self.codes)
            self.codes.update(zip(new, range(first, first + len(new))))
            self._learn(new)
        codes = np.fromiter(map(self.codes.__getitem__, split), np.int64, len(split))
        lens = self.lens[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[codes] - (ends - lens), lens) + np.arange(total)
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return self.flat[where], upto

    def _split(self, text: str) -> list[str]:
        if MARK not in text:
            return self.chunks.findall(MARK + text.replace(" ", MARK))
        # a marker of the text itself is a chunk that no piece covers, see _literal
        out = []
        for i, part in enumerate(text.split(MARK)):
            marked = part.replace(" ", MARK)
            out.extend(["\0" + MARK] if i else [])
            out.extend(self.chunks.findall(marked if i else MARK + marked))
        self._literal()
        return out

    def _literal(self) -> None:
        key = "\0" + MARK
        if key not in self.codes:
            ids = self.vocabulary.byte_ids[list(MARK.encode())].astype(np.int32)
            self.codes[key] = len(self.codes)
            self.starts = np.append(self.starts, len(self.flat))
            self.lens = np.append(self.lens, len(ids))
            self.flat = np.concatenate([self.flat, ids])


def decoder(vocabulary: Vocabulary):
    """``ids -> text``: pieces side by side, markers as spaces, bytes as UTF-8, without
    the space that stands for the marker in front."""
    v = vocabulary
    table = [p.replace(MARK.encode(), b" ") if ok else b"" for p, ok in zip(v.pieces, v.normal)]
    for byte, i in enumerate(v.byte_ids):
        table[i] = bytes([byte])

    def decode(ids: list[int]) -> str:
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")[1:] if ids else ""

    return decode


def encode(docs: DataFrame, model: str = MODEL, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then ``n_tokens``, ``n_bytes`` (byte pieces), ``ids`` and
    ``exact``: whether decoding the ids gives the text back."""
    vocabulary = Vocabulary.load(model)
    encoder = Encoder(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(encoder)
    rows = pick(docs, *keep, "text") if "text" not in keep else pick(docs, *keep)
    schema = T.StructType([*[f for f in rows.schema.fields if f.name in keep],
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_bytes", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("exact", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = shared.value
        decode = decoder(enc.vocabulary)
        is_byte = np.zeros(len(enc.vocabulary.pieces) + 1, np.int64)
        is_byte[enc.vocabulary.byte_ids] = 1
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            lengths = [x or 0 for x in pc.utf8_length(column).to_pylist()]
            for lo, hi in _ranges(lengths):
                texts = column.slice(lo, hi - lo).to_pylist()
                ids, at = enc.encode(texts)
                spelled = np.concatenate([[0], np.cumsum(is_byte[ids])])
                values = pa.array(ids, pa.int32())
                exact = [decode(ids[a:b].tolist()) == (t or "")
                         for t, a, b in zip(texts, at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(batch.schema.get_field_index(k)).slice(lo, hi - lo)
                       for k in keep],
                     pa.array(np.diff(at), pa.int64()),
                     pa.array(spelled[at[1:]] - spelled[at[:-1]], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), values),
                     pa.array(exact, pa.bool_())],
                    names=[f.name for f in schema.fields])

    return rows.mapInArrow(run, schema)


def _ranges(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``SLICE`` characters together (a longer text is one run)."""
    lo = size = 0
    for i, n in enumerate(lengths):
        if i > lo and size + n > SLICE:
            yield lo, i
            lo, size = i, 0
        size += n
    if lengths:
        yield lo, len(lengths)
