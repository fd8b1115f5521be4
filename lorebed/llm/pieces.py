"""SentencePiece encoding and decoding by a batched numpy Viterbi.

Words of equal length advance together, one character at a time. The hashes of all substrings probe the sorted piece keys first;
at each end the pieces found make a row of scores, of which the largest is kept with a backpointer. For a byte-pair model a plain sum of scores picks
other pieces than the merges do, so the score of a step from piece ``a`` to piece ``b`` counts only if the merges leave ``a b``
as these two pieces. A prefix of an encoding is the encoding of that prefix, which makes one
piece admissible at each end: the largest sum over admissible steps is the model's own encoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .job import ship
from .textblocks import U64, hash_spans, mix, text_blocks

MARK = 0x2581
BLOCK = 2 << 20
_STEP = U64(0x9E3779B97F4A7C15)
_CACHE_BITS = 21
#: Longer words are cut between characters that no piece has side by side, which no merge can join.
_LONG = 48
#: Fills short rows; no character.
_NONE = 0xFFFFFFFF


def _probe(keys: np.ndarray, marked: np.ndarray, shift: U64, wanted: np.ndarray) -> np.ndarray:
    """The position of each wanted key in the sorted keys, or -1."""
    out = np.full(wanted.shape, -1, dtype=np.int64)
    maybe = np.flatnonzero(marked[wanted >> shift])
    if len(maybe):
        found = wanted[maybe]
        at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        out[maybe] = np.where(keys[at] == found, at, -1)
    return out


def _marks(keys: np.ndarray, bits: int) -> np.ndarray:
    table = np.zeros(1 << bits, dtype=bool)
    table[keys >> U64(64 - bits)] = True
    return table


class Pieces:
    """The vocabulary of a byte-pair SentencePiece model with byte fallback, as arrays."""

    def __init__(self, pieces: list[str], scores: list[float], unknown: int, byte_ids: list[int], special: set[int]):
        self.n, self.unknown, self.byte_ids = len(pieces), unknown, np.array(byte_ids, dtype=np.int32)
        self.scores = np.array(scores, dtype=np.float64)
        self.own = [i for i in range(len(pieces)) if i not in special]
        self.longest = max(len(pieces[i]) for i in self.own)
        chars = {pieces[i]: i for i in self.own if len(pieces[i]) == 1}
        text = {pieces[i]: i for i in self.own}
        self.beside = np.unique(np.array([ord(x) << 32 | ord(y) for i in self.own for x, y in zip(pieces[i], pieces[i][1:])], dtype=U64))
        h = np.zeros(len(self.own), dtype=U64)
        points = np.zeros((self.n, self.longest), dtype=np.uint32)
        self.lengths = np.zeros(self.n, dtype=np.int64)
        self.chars = np.full((self.n, self.longest), -1, dtype=np.int32)
        for i in self.own:
            p = pieces[i]
            self.lengths[i] = len(p)
            points[i, : len(p)] = [ord(c) for c in p]
            self.chars[i, : len(p)] = [chars.get(c, -1) for c in p]
        for k in range(self.longest):
            inside = self.lengths[self.own] > k
            h[inside] = h[inside] * _STEP + points[self.own, k][inside].astype(U64) + U64(1)
        self.points = points
        h = mix(h)
        order = np.argsort(h)
        self.keys, self.ids = h[order], np.array(self.own, dtype=np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces share a key")
        pairs = {}
        for p, i in text.items():
            for k in range(1, len(p)):
                a, b = text.get(p[:k]), text.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.n + b] = i
        joined = mix(np.array(sorted(pairs), dtype=U64) * _STEP)
        order = np.argsort(joined)
        self.pair_keys, self.pair_ids = joined[order], np.array([pairs[k] for k in sorted(pairs)], dtype=np.int64)[order]
        self.marked, self.pair_marked = _marks(self.keys, 20), _marks(self.pair_keys, 22)
        runs = [i for i in self.own if set(pieces[i]) == {chr(MARK)}]
        self.mark = text[chr(MARK)]
        self.longest_run = max(len(pieces[i]) for i in runs)
        longer = [i for i in runs if len(pieces[i]) > 1]
        others = [i for i in self.own if i not in set(runs) and len(pieces[i]) > 1]
        if (longer and others and max(self.scores[longer]) >= min(self.scores[others])) or len(set(self.scores[longer])) > 1:
            raise ValueError("runs of spaces are expected to merge last, and from the left")
        if any(chr(MARK) in pieces[i][1:] for i in others):
            raise ValueError("a piece goes over the end of a word")
        each, left = self.merged(np.full((self.longest_run, self.longest_run), self.mark), np.arange(1, self.longest_run + 1))
        #: The pieces of 1, 2, ... spaces; more spaces are as many of the longest run and a rest.
        self.runs = [each[k, : left[k]].tolist() for k in range(self.longest_run)]
        ids = np.array(self.own)
        alone, left = self.merged(self.chars[ids], self.lengths[ids])
        self.whole = np.zeros(self.n, dtype=bool)
        self.whole[ids] = (left == 1) & (alone[:, 0] == ids)
        data = [
            bytes([byte_ids.index(i)]) if i in set(byte_ids) else b"" if i in special else pieces[i].replace(chr(MARK), " ").encode() for i in range(self.n)
        ]
        data[unknown] = " ⁇ ".encode()
        self.byte_starts = np.concatenate([[0], np.cumsum([len(x) for x in data])])
        self.bytes = np.frombuffer(b"".join(data), dtype=np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Empty caches, which belong to this object and to one process."""
        self._words = _Words()
        self._pair_keys = np.full(1 << _CACHE_BITS, -1, dtype=np.int64)
        self._pair_answers = np.zeros(1 << _CACHE_BITS, dtype=bool)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_words", "_pair_keys", "_pair_answers")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def merged(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges neighbours, best score first and from the left, until none is left: pieces and their number."""
        ids, left = ids.astype(np.int64), lengths.copy()
        active = np.flatnonzero(left > 1)
        while len(active):
            width = int(left[active].max())
            rows = ids[active, :width]
            a, b = rows[:, :-1], rows[:, 1:]
            real = (np.arange(1, width) < left[active, None]) & (a >= 0) & (b >= 0)
            found = np.full(a.shape, -1, dtype=np.int64)
            at = _probe(self.pair_keys, self.pair_marked, U64(42), mix((a[real] * self.n + b[real]).astype(U64) * _STEP))
            found[real] = np.where(at >= 0, self.pair_ids[at], -1)
            score = np.where(found >= 0, self.scores[found], -np.inf)
            best = score.argmax(axis=1)
            some = np.flatnonzero(score[np.arange(len(best)), best] > -np.inf)
            rows, best, active = rows[some], best[some], active[some]
            new = found[some, best]
            columns = np.arange(width - 1)
            rows = np.take_along_axis(rows, columns + (columns > best[:, None]), axis=1)
            rows[np.arange(len(some)), best] = new
            ids[active, : width - 1] = rows
            left[active] -= 1
            active = active[left[active] > 1]
        return ids, left

    def admissible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of piece a and piece b gives back a and b; a cache remembers past answers."""
        known, answer = self._pair_keys, self._pair_answers
        key = a * self.n + b
        slot = (mix(key.astype(U64)) >> U64(64 - _CACHE_BITS)).astype(np.int64)
        missing = known[slot] != key
        out = answer[slot]
        if missing.any():
            new = np.unique(key[missing])
            p, q = new // self.n, new % self.n
            free = (p == self.unknown) | (q == self.unknown)
            rows = np.full((len(new), 2 * self.longest), -1, dtype=np.int64)
            rows[:, : self.longest] = self.chars[p]
            columns = np.arange(self.longest)
            rows[np.arange(len(new))[:, None], self.lengths[p][:, None] + columns] = self.chars[q]
            ids, left = self.merged(rows, np.where(free, 0, self.lengths[p] + self.lengths[q]))
            fine = free | ((left == 2) & (ids[:, 0] == p) & (ids[:, 1] == q))
            at = (mix(new.astype(U64)) >> U64(64 - _CACHE_BITS)).astype(np.int64)
            known[at], answer[at] = new, fine
            out[missing] = fine[np.searchsorted(new, key[missing])]
        return out

    def candidates(self, words: np.ndarray, exact: bool = False) -> np.ndarray:
        """The piece of each size that ends at each place of each word, or -1; with ``exact`` its characters are compared too."""
        n, length = words.shape
        total = np.zeros((n, length + 1), dtype=U64)
        for i in range(length):
            total[:, i + 1] = total[:, i] * _STEP + words[:, i].astype(U64) + U64(1)
        width = min(self.longest, length)
        out = np.full((length + 1, n, width), -1, dtype=np.int32)
        power = 1
        for size in range(1, width + 1):
            power = power * int(_STEP) & 0xFFFFFFFFFFFFFFFF
            at = _probe(self.keys, self.marked, U64(44), mix(total[:, size:] - total[:, :-size] * U64(power)).reshape(-1)).reshape(n, -1)
            row, place = np.nonzero(at >= 0)
            piece = self.ids[at[row, place]]
            if exact:
                alike = self.lengths[piece] == size
                for k in range(size):
                    alike &= self.points[piece, k] == words[row, place + k]
                row, place, piece = row[alike], place[alike], piece[alike]
            out[place + size, row, size - 1] = piece
        return out

    def viterbi(self, words: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Words of one length, as code points: the best piece that ends at each place, and its backpointer's length."""
        n, length = words.shape
        found = self.candidates(words, exact)
        best = np.zeros((length + 1, n))
        last = np.full((length + 1, n), -1, dtype=np.int64)
        back = np.zeros((length + 1, n), dtype=np.int64)
        rows = np.arange(n)
        for end in range(1, length + 1):
            here = found[end, :, : min(end, found.shape[2])]
            row, size = np.nonzero(here >= 0)
            piece, start = here[row, size].astype(np.int64), end - 1 - size
            before = last[start, row]
            fine = self.whole[piece]
            inner = np.flatnonzero(start)
            fine[inner] = self.admissible(before[inner], piece[inner])
            scores = np.full(here.shape, -np.inf)
            scores[row[fine], size[fine]] = best[start[fine], row[fine]] + self.scores[piece[fine]]
            pick = scores.argmax(axis=1)
            top = scores[rows, pick]
            some = top > -np.inf
            last[end] = np.where(some, here[rows, pick], self.unknown)
            back[end] = np.where(some, pick + 1, 1)
            best[end] = np.where(some, top, best[end - 1])
        return last, back

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a block, and where each text's begin."""
        return self.encode_checked(data, offsets)[:2]

    def encode_checked(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``encode``, and whether decoding the ids gives each text back.

        Equal words are found by their hashes. A text that reads back otherwise had a word with another word's hash;
        it is encoded again word by word, with pieces compared character by character.
        """
        ids, at = self._encode(data, offsets)
        same = self._reads_back(ids, at, data, offsets)
        if same.all():
            return ids, at, same
        parts = np.split(ids, at[1:-1])
        for i in np.flatnonzero(~same):
            own = data[offsets[i] : offsets[i + 1]]
            parts[i], own_at = self._encode(own, np.array([0, len(own)]), exact=True)
            same[i] = self._reads_back(parts[i], own_at, own, np.array([0, len(own)]))[0]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]), same

    def _reads_back(self, ids: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        back, back_at = self.decode(ids, at)
        if len(back) == len(data) and np.array_equal(back_at, offsets):
            wrong = np.concatenate([[0], np.cumsum(back != data)])
            return np.diff(wrong[offsets]) == 0
        return np.array([np.array_equal(back[a:b], data[c:d]) for a, b, c, d in zip(back_at, back_at[1:], offsets, offsets[1:])], dtype=bool)

    def _encode(self, data: np.ndarray, offsets: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        at = np.searchsorted(byte_of, offsets)
        some = np.diff(at) > 0
        points = np.where(points == 32, np.uint32(MARK), points)
        points = np.insert(points, at[:-1][some], np.uint32(MARK))
        put = at[:-1][some] + np.arange(some.sum())
        at = at + np.concatenate([[0], np.cumsum(some)])
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        blank = points == MARK
        start = np.zeros(len(points), dtype=bool)
        start[put] = True
        begins = blank & (start | ~np.concatenate([[False], blank[:-1]]))
        begin = np.flatnonzero(begins)
        end = np.append(begin[1:], len(points))
        blanks = np.concatenate([[0], np.cumsum(blank)])
        core = begin + (blanks[end] - blanks[begin]) - 1
        if exact:
            ids, sizes = self._segment(points, core, end, exact=True)
            starts, inverse = np.cumsum(sizes) - sizes, np.arange(len(core))
        else:
            given = np.cumsum(~start) - ~start  # how many of the text's own characters come before
            own = np.append(given, given[-1] + (not start[-1]))
            hashes = hash_spans(data, byte_of[own[core + 1]], byte_of[own[end]])
            words, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            ids, starts, sizes = self._words.recall(words, lambda new: self._segment(points, core[index[new]], end[index[new]]))
        count, first = sizes[inverse], starts[inverse]
        out_at = np.concatenate([[0], np.cumsum(count)])
        out = ids[np.arange(out_at[-1]) - np.repeat(out_at[:-1] - first, count)].astype(np.int32)
        extra = core - begin
        if extra.any():
            out, out_at = self._with_runs(out, out_at, extra)
        return out, out_at[np.searchsorted(begin, at)]

    def _segment(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray, exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, one word after the other, and how many each has."""
        first, after, word = self._cut(points, begin, end)
        length = after - first
        # Longer stretches are few of each length, and advance together with others, filled up to a common length.
        room = np.where(length <= _LONG, length, 1 << np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64))
        pieces: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        place: list[np.ndarray] = []
        for size in np.unique(room):
            mine = np.flatnonzero(room == size)
            wide = int(length[mine].max())
            for part in np.array_split(mine, max(1, min(len(mine), len(mine) * wide // 200_000))):
                step = np.arange(int(length[part].max()))
                rows = points[np.minimum(first[part][:, None] + step, len(points) - 1)]
                rows = np.where(step < length[part][:, None], rows, np.uint32(_NONE))
                last, back = self.viterbi(rows, exact)
                at_end = length[part].copy()
                rows = np.arange(len(part))
                while len(rows):
                    step = back[at_end[rows], rows]
                    pieces.append(last[at_end[rows], rows])
                    owner.append(word[part[rows]])
                    place.append(first[part[rows]] + at_end[rows] - step)
                    at_end[rows] -= step
                    rows = rows[at_end[rows] > 0]
        ids, own = self._bytes_for_unknown(np.concatenate(pieces), np.concatenate(owner), np.concatenate(place), points)
        return ids, np.bincount(own, minlength=len(begin))

    def _cut(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, word) of stretches that can be encoded on their own: short words, and parts of long ones."""
        long = end - begin > _LONG
        own = np.arange(len(begin))
        first, after, word = [begin[~long]], [end[~long]], [own[~long]]
        for a, b, i in zip(begin[long], end[long], own[long]):
            pair = points[a : b - 1].astype(U64) << U64(32) | points[a + 1 : b].astype(U64)
            near = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
            cuts = a + 1 + np.flatnonzero(self.beside[near] != pair)
            first.append(np.concatenate([[a], cuts]))
            after.append(np.concatenate([cuts, [b]]))
            word.append(np.full(len(cuts) + 1, i))
        return np.concatenate(first), np.concatenate(after), np.concatenate(word)

    def _bytes_for_unknown(self, ids, own, where, points):
        """Pieces in order, an unknown character as the pieces of its bytes."""
        order = np.lexsort((where, own))
        ids, own, where = ids[order], own[order], where[order]
        unknown = np.flatnonzero(ids == self.unknown)
        if not len(unknown):
            return ids, own
        raw = [chr(points[i]).encode() for i in where[unknown]]
        width = np.ones(len(ids), dtype=np.int64)
        width[unknown] = [len(x) for x in raw]
        ids, own = np.repeat(ids, width), np.repeat(own, width)
        is_unknown = np.zeros(len(width), dtype=bool)
        is_unknown[unknown] = True
        ids[np.repeat(is_unknown, width)] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return ids, own

    def _with_runs(self, ids, at, extra):
        """Puts the pieces of further spaces before their words; a space that its word leaves alone joins them."""
        alone = ids[at[:-1]] == self.mark
        rows = np.flatnonzero(extra)
        most = self.longest_run
        parts, spots = [], []
        drop = np.ones(len(ids), dtype=bool)
        for r in rows:
            k = int(extra[r]) + int(alone[r])
            drop[at[r]] = not alone[r]
            run = self.runs[-1] * (k // most) + (self.runs[k % most - 1] if k % most else [])
            parts.extend(run)
            spots.extend([at[r]] * len(run))
        size = np.diff(at)
        size[rows] -= alone[rows]
        size += np.bincount(np.searchsorted(at, spots, "right") - 1, minlength=len(size))
        kept = np.concatenate([[0], np.cumsum(drop)])
        return np.insert(ids[drop], kept[spots], np.array(parts, dtype=np.int32)), np.concatenate([[0], np.cumsum(size)])

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all texts, and where each begins; the space that encoding puts first is left out."""
        size = np.diff(self.byte_starts)[ids]
        out_at = np.concatenate([[0], np.cumsum(size)])
        out = self.bytes[np.arange(out_at[-1]) - np.repeat(out_at[:-1] - self.byte_starts[ids], size)]
        starts = out_at[at]
        some = np.flatnonzero(np.diff(starts))
        led = some[out[starts[some]] == 32]
        keep = np.ones(len(out), dtype=bool)
        keep[starts[led]] = False
        return out[keep], np.concatenate([[0], np.cumsum(keep)])[starts]


class _Words:
    """The pieces of words that a task has met; it starts anew when it is full."""

    FULL = 1 << 18

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, U64)
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def recall(self, words: np.ndarray, segment) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's begin, how many it has) of the sorted word hashes; segment gets the places of new ones."""
        if len(self.keys) > self.FULL:
            self.clear()
        at = np.searchsorted(self.keys, words)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == words[known]
        new = np.flatnonzero(~known)
        if len(new):
            ids, sizes = segment(new)
            starts = len(self.ids) + np.cumsum(sizes) - sizes
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.keys = np.insert(self.keys, at[new], words[new])
            self.starts = np.insert(self.starts, at[new], starts)
            self.sizes = np.insert(self.sizes, at[new], sizes)
            at = np.searchsorted(self.keys, words)
        return self.ids, self.starts[at], self.sizes[at]


def load(model_file: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    byte_ids = [i for i in ids if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte fallback")
    special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    return Pieces([model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], model.unk_id(), byte_ids, special)


def encode(docs: DataFrame, pieces: Pieces, text_col: str = "text") -> DataFrame:
    """The rows with ids array<int>, n_tokens and round_trip: whether decoding the ids gives the text back.

    Input columns of these names are replaced. A null text counts as empty and has no ids. The vocabulary is the only
    thing that is broadcast. A text that holds the model's own space mark (U+2581) reads back with a space there.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.drop("ids", "n_tokens", "round_trip")
    shared = spark.sparkContext.broadcast(pieces)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(at), BLOCK):
                ids, starts, same = shared.value.encode_checked(data, offsets)
                rows = batch.slice(first, last - first)
                lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, lists, pa.array(np.diff(starts)), pa.array(same)],
                    names=[*batch.schema.names, "ids", "n_tokens", "round_trip"]
                )

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def decode(encoded: DataFrame, pieces: Pieces, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """The rows with the text of their ids; null ids are the empty text, and bytes that aren't UTF-8 become U+FFFD."""
    spark = encoded.sparkSession
    ship(spark)
    encoded = encoded.drop(out_col)
    shared = spark.sparkContext.broadcast(pieces)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            flat = np.asarray(lists.flatten()).astype(np.int64)
            size = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], dtype=np.int64)
            back, starts = shared.value.decode(flat, np.concatenate([[0], np.cumsum(size)]))
            texts = [back[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))
