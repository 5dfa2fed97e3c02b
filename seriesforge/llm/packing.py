"""Best-fit packing of tokenised documents with a swap-based local search.

Documents become ids, are cut into pieces where longer than a sequence, and pieces are dealt evenly
into groups that one task packs: best fit decreasing first, then local search. The emptiest bin gives
its documents away by moves, one-for-one, two-for-one and one-for-two exchanges with other underfull
bins; every step raises the sum of squared fills, and the search goes on until the bin is empty or
nothing helps. Bins that stay badly filled are pooled across groups and packed again until one group
holds them. Only ids' lengths and checksums travel, never texts.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, materialize, slices, worker_cache

SEQUENCE, END_ID = 4096, 1
GROUP_ROWS = 20_000
#: Bins filled less than this share are pooled across groups.
POOL_BELOW = 0.97


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """ids (little-endian unsigned 32-bit) of white-space separated words, kept for the next time.

    A token never spans ASCII white space, so a text's ids are those of its words. Words of Latin-1
    letters take the vocabulary's own pre-tokeniser pattern and its merge model directly; any
    other word goes through the whole tokenizer. The memory is emptied when full; results don't
    depend on it.
    """

    _LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
    _PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
    _PLAIN = re.compile("[!-;=-~¡-ÿ]+")  # no '<': special tokens start with it

    def __init__(self, path: str, most: int = 450_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.direct = "ByteLevel" in str(self.tokenizer.pre_tokenizer) and "\\\\p{L}" in repr(self.tokenizer.pre_tokenizer.__getstate__())
        # Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(256 + k) for k, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        plain = "<" not in word and word.isprintable() if word.isascii() else self._PLAIN.fullmatch(word)
        if not (self.direct and plain):
            ids = pack_ids(self.tokenizer.encode(word, add_special_tokens=False).ids)
        else:
            parts = self._PARTS.findall(word.lower())
            if len(parts) == 1 and parts[0] == word:
                mapped = word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.alphabet)
                ids = pack_ids([t.id for t in self.tokenizer.model.tokenize(mapped)])
            else:  # parts are words of their own
                ids = b"".join([self[p] for p in parts])
        if len(self) >= self.most:
            self.clear()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if "<|" in text:  # a special token may hold or touch anything
            return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, _words(text)))


#: White space that str.split() knows beyond blank, tab, newline and carriage return.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _words(text: str) -> list[str]:
    """Words between blanks, tabs, newlines and carriage returns."""
    return [w for w in re.split("[ \t\n\r]+", text) if w] if _ODD_SPACE.search(text) else text.split()


def _pieces(path: str, sequence: int, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        if path not in cache:
            cache[path] = WordIds(path)
        words, end = cache[path], pack_ids([end_id])
        for batch in slices(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.ids(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * sequence)):
                    own = ids[at : at + 4 * sequence]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def best_fit(lengths: np.ndarray, room: int) -> list[list[int]]:
    """Best fit decreasing: each item goes to the fullest bin it fits; bins as lists of item numbers."""
    bins, open_, mask = [], [[] for _ in range(room + 1)], 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            at = open_[free].pop()
            if not open_[free]:
                mask &= ~(1 << free)
            bins[at].append(item)
        else:
            free, at = room, len(bins)
            bins.append([item])
        left = free - n
        open_[left].append(at)
        mask |= 1 << left
    return bins


class _Underfull:
    """Items and pairs of items of underfull bins as arrays, for one look over all of them."""

    def __init__(self, lengths: np.ndarray, bins: dict[int, list[int]], most_pairs: int = 24):
        single, pairs = [], []
        for b, items in bins.items():
            single += [(lengths[i], b, i) for i in items]
            # The pairs of a bin's longest items; a bin of very many tiny ones needs no exchange.
            longest = sorted(items, key=lambda i: -lengths[i])[:most_pairs]
            pairs += [(lengths[i] + lengths[j], b, i, j) for i, j in combinations(longest, 2)]
        self.single = np.array(single, np.int64).reshape(-1, 3)
        self.pairs = np.array(pairs, np.int64).reshape(-1, 4)


def local_search(lengths: np.ndarray, bins: list[list[int]], room: int, tries: int = 24, steps: int = 400) -> list[list[int]]:
    """Empty the emptiest bins into other underfull ones; each step raises the sum of squared fills."""
    held = {k: list(b) for k, b in enumerate(bins)}
    fill = {k: int(lengths[b].sum()) for k, b in held.items()}
    least, stuck = -(-int(lengths.sum()) // room), set()
    while len(held) > least and len(stuck) < tries:
        donors = [k for k in sorted(held, key=lambda k: (fill[k], k)) if k not in stuck and fill[k] < room]
        if not donors:
            break
        donor = donors[0]
        for _ in range(steps):
            if not held[donor]:
                break
            # The fullest share of underfull bins has little to offer; look at the 2,000 emptiest.
            others = sorted((k for k in held if k != donor and fill[donor] <= fill[k] < room), key=lambda k: (fill[k], k))[:2000]
            if not others:
                break
            free = np.zeros(max(held) + 1, np.int64)
            free[others] = [room - fill[k] for k in others]
            view = _Underfull(lengths, {k: held[k] for k in others})
            best = (0, None)
            own = held[donor]
            for a in sorted(own, key=lambda i: -lengths[i]):  # a move gives the whole document
                fits = [k for k in others if room - fill[k] >= lengths[a]]
                if fits:
                    best = (int(lengths[a]), ([a], min(fits, key=lambda k: room - fill[k]), []))
                    break
            if best[1] is None:
                gives = [([a], int(lengths[a])) for a in own]
                gives += [([a, b], int(lengths[a] + lengths[b])) for a, b in combinations(sorted(own, key=lambda i: -lengths[i])[:12], 2)]
                for given, size in gives:
                    for rows, back in ((view.single, 1), (view.pairs, 2)):
                        if len(rows) and back + len(given) <= 3:
                            gain = size - rows[:, 0]
                            gain[(gain > free[rows[:, 1]])] = 0
                            k = int(gain.argmax())
                            if gain[k] > best[0]:
                                best = (int(gain[k]), (given, int(rows[k, 1]), rows[k, 2:].tolist()))
            if best[1] is None:
                break
            gain, (given, other, back) = best
            held[donor] = [i for i in own if i not in given] + back
            held[other] = [i for i in held[other] if i not in back] + given
            fill[donor] -= gain
            fill[other] += gain
        if held[donor]:
            stuck.add(donor)
        else:
            del held[donor], fill[donor]
    return list(held.values())


def _packed(room: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        # The same bins whatever order the rows came in.
        table = table.sort_by([(c, "descending") for c in ("length", "doc_id", "piece", "ids_crc32", "start")])
        lengths = table.column("length").to_numpy()
        bins = local_search(lengths, best_fit(lengths, room), room)
        order = np.concatenate([np.array(b) for b in bins])
        first = TaskContext.get().partitionId() << 32
        sequence = np.repeat(np.arange(len(bins)) + first, [len(b) for b in bins])
        offset = np.concatenate([np.cumsum(np.r_[0, lengths[b][:-1]]) for b in bins])
        fill = np.repeat([int(lengths[b].sum()) for b in bins], [len(b) for b in bins])
        out = table.take(pa.array(order))
        for name, values in (("sequence_id", sequence), ("offset", offset), ("fill", fill)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        yield from out.to_batches()

    return run


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """A row per piece of each document: doc_id, piece, start, length, ids_crc32."""
    return documents(docs).mapInArrow(_pieces(path or default_tokenizer(), sequence, end_id), _PIECE)


def pack(cut: DataFrame, sequence: int = SEQUENCE, group_rows: int = GROUP_ROWS, pool_below: float = POOL_BELOW) -> DataFrame:
    """Place pieces into sequences: adds sequence_id and offset. Rounds end when one group packs the rest."""
    todo, placed, level = materialize(cut, "pieces"), [], 0
    n = todo.count()
    while True:
        groups = max(1, -(-n // group_rows))
        packed = materialize(
            todo.repartition(groups).mapInArrow(_packed(sequence), f"{_PIECE}, sequence_id long, offset long, fill long"), "packed"
        ).withColumn("sequence_id", F.col("sequence_id") + F.lit(level << 56))
        level += 1
        pool = packed.where(F.col("fill") < int(sequence * pool_below))
        left = pool.count() if groups > 1 else 0
        if not left or left == n:
            placed.append(packed.drop("fill"))
            break
        placed.append(packed.where(F.col("fill") >= int(sequence * pool_below)).drop("fill"))
        todo, n = materialize(pool.drop("sequence_id", "offset", "fill"), "pool"), left
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each row of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and one piece of the end id alone. Repeated rows are packed as often as
    they come. A document longer than a sequence is cut into full pieces, the last may be shorter;
    no other is cut. An empty table gives an empty result.
    """
    return pack(pieces(docs, path, sequence, end_id), sequence)
