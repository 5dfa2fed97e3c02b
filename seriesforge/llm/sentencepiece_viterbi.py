"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best segmentation of a text is the one whose pieces' scores in the model file sum highest; of equal
sums the one whose last piece starts first. The search reads the text once: it needs the scores of as
many positions as the longest piece has characters, and backpointers back to the last commit. Whenever
the backpointer chains of all positions a later piece could start from meet in one boundary,
everything before it is settled and its ids are emitted. In a run of one character or of another short
period the chains may never meet; what is held then grows with the run (no id of it is settled
before its end is seen), in linear time.

A piece never holds a word mark after another character (the vocabulary is checked for it), so chains
always meet before a word mark; words are therefore kept with their ids. Characters outside the
vocabulary become byte pieces. Nothing is trained here, the model file is a parameter.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from seriesforge.llm.common import documents, slices, worker_cache

MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: ids and scores of the text pieces, and ids of the byte pieces."""

    def __init__(self, ids: dict[str, int], scores: dict[str, float], bytes_: dict[int, int]):
        self.ids, self.scores, self.bytes = ids, scores, bytes_
        self.longest = max(map(len, ids), default=1)
        #: A tree of characters: character to (what may follow, score and id of the piece that ends here or None).
        self.tree: dict = {}
        for piece, score in scores.items():
            at = self.tree
            for c in piece[:-1]:
                at = at.setdefault(c, [{}, None, None])[0]
            at.setdefault(piece[-1], [{}, None, None])[1:] = score, ids[piece]
        #: Score of a character that only bytes can spell: below any sum of pieces of one character.
        self.fallback = min(scores.values(), default=0.0) - 10.0
        self.word_bound = not any(re.search(f"[^{MARK}]{MARK}", p) for p in ids)
        self.data = {i: p.replace(MARK, " ").encode() for p, i in ids.items()} | {i: bytes([b]) for b, i in bytes_.items()}

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids, scores, bytes_ = {}, {}, {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                bytes_[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[piece], scores[piece] = i, model.get_score(i)
        return cls(ids, scores, bytes_)


class StreamingViterbi:
    """Feed characters in any portions; ids come out as soon as they are settled.

    In a periodic text the chains may never meet: then what is held grows with the period's run, and only
    whenever it has doubled the chains are followed again, so the time stays linear.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.text: list[str] = []  # characters after the committed boundary
        self.best: list[float] = [0.0]  # best score of each boundary in it
        self.back: list[int] = [0]
        self.due = 2 * pieces.longest  # length at which the chains are followed next; a window's worth is kept anyway
        self.widest = 0  # characters ever held, for tests

    def feed(self, portion: str) -> list[int]:
        out: list[int] = []
        step = 4 * self.pieces.longest
        for at in range(0, len(portion), step):
            self._extend(portion[at : at + step])
            if len(self.text) > self.due:
                out += self._commit()
                self.due = 2 * max(len(self.text), self.pieces.longest)
        return out

    def finish(self) -> list[int]:
        out = self._ids(0, len(self.text))
        self.text, self.best, self.back, self.due = [], [0.0], [0], 2 * self.pieces.longest
        return out

    def _extend(self, portion: str) -> None:
        p, text = self.pieces, self.text
        done = len(text)
        text += portion
        n = len(text)
        best, back = self.best, self.back
        best += [float("-inf")] * len(portion)
        back += [0] * len(portion)
        # Pieces that end in the new portion may start in the window before it.
        tree, longest, fallback = p.tree, p.longest, p.fallback
        for start in range(max(0, done - longest + 1), n):
            base, follow = best[start], tree
            for end in range(start + 1, n + 1):
                step = follow.get(text[end - 1])
                if step is None:
                    if end == start + 1 and end > done and base + fallback > best[end]:
                        best[end], back[end] = base + fallback, start
                    break
                follow, score, _ = step
                if score is None:
                    if end > start + 1:
                        continue
                    score = fallback  # begins pieces but is none
                # A start before this one was there first and wins ties.
                if base + score > best[end] and end > done:
                    best[end], back[end] = base + score, start
        self.widest = max(self.widest, n)

    def _commit(self) -> list[int]:
        """Ids before the last boundary that the chains of all living positions share."""
        n, back = len(self.text), self.back
        alive = set(range(max(0, n - self.pieces.longest + 1), n + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(back[last])
        (meet,) = alive
        if not meet:
            return []
        out = self._ids(0, meet)
        floor = self.best[meet]
        self.text = self.text[meet:]
        self.best = [b - floor for b in self.best[meet:]]
        self.back = [max(0, b - meet) for b in back[meet:]]
        return out

    def _ids(self, low: int, high: int) -> list[int]:
        parts: list[list[int]] = []
        while high > low:
            start = self.back[high]
            piece = "".join(self.text[start:high])
            known = self.pieces.ids.get(piece)
            parts.append([known] if known is not None else [self.pieces.bytes[b] for b in piece.encode("utf-8", "replace")])
            high = start
        return [i for part in reversed(parts) for i in part]


def viterbi(pieces: Pieces, text: str) -> list[int]:
    search = StreamingViterbi(pieces)
    return search.feed(text) + search.finish()


def word_ids(pieces: Pieces, word: str) -> list[int]:
    """The same for a text short enough to be held whole: nothing is committed, and ids are noted on the way."""
    n, tree, fallback = len(word), pieces.tree, pieces.fallback
    best, back, via = [0.0] + [float("-inf")] * n, [0] * (n + 1), [None] * (n + 1)
    for start in range(n):
        base, end, step = best[start], start + 1, tree.get(word[start])
        if step is None or step[1] is None:
            if base + fallback > best[end]:
                best[end], back[end], via[end] = base + fallback, start, None
            if step is None:
                continue
        elif base + step[1] > best[end]:
            best[end], back[end], via[end] = base + step[1], start, step[2]
        follow = step[0]
        for c in word[end:]:
            step = follow.get(c)
            if step is None:
                break
            end += 1
            follow, score, found = step
            if score is not None and base + score > best[end]:
                best[end], back[end], via[end] = base + score, start, found
    out, end = [], n
    while end:
        start = back[end]
        if via[end] is None:
            out += [pieces.bytes[b] for b in reversed(word[start:end].encode("utf-8", "replace"))]
        else:
            out.append(via[end])
        end = start
    out.reverse()
    return out


class Encoder(dict):
    """ids of marked words (little-endian unsigned 32-bit), kept for the next time, emptied when full."""

    def __init__(self, pieces: Pieces, most: int = 300_000, longest_word: int = 64):
        self.pieces, self.most, self.longest_word = pieces, most, longest_word

    def __missing__(self, word: str) -> bytes:
        short = len(word) <= self.longest_word
        ids = word_ids(self.pieces, word) if short else viterbi(self.pieces, word)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if short:
            if len(self) >= self.most:
                self.clear()
            self[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """ids of a text; an empty text has none. A word mark is put before the text, blanks become marks."""
        if not text:
            return b""
        if not self.pieces.word_bound:
            return self[MARK + text.replace(" ", MARK)]
        # Cut before each run of marks: no piece reaches over the border before a mark.
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            return b"".join(map(self.__getitem__, _RUNS.findall(MARK + text.replace(" ", MARK))))
        return b"".join(map(self.__getitem__, [MARK + w for w in text.split(" ")]))


_RUNS = re.compile(f"{MARK}+[^{MARK}]*")


def decode(pieces: Pieces, ids: Iterable[int]) -> str:
    """The text of ids: marks become blanks, byte pieces their bytes, the leading blank goes."""
    data = pieces.data
    text = b"".join([data.get(i, b"") for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _coder(path: str) -> tuple[Pieces, Encoder]:
    cache = worker_cache()
    if path not in cache:
        pieces = Pieces.load(path)
        cache[path] = (pieces, Encoder(pieces))
    return cache[path]


def _encoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _coder(path)
        for batch in slices(batches):
            ids = [memoryview(encoder.encode(t)).cast("I").tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return run


def _decoded(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _ = _coder(path)
        for batch in slices(batches):
            texts = [decode(pieces, ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the ids of every whole text; a null or empty text has an empty list."""
    return documents(docs).mapInArrow(_encoded(path or default_model()), "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give an empty text, unknown ids nothing."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path or default_model()), "doc_id long, text string")


def _round_trip(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, encoder = _coder(path)
        for batch in slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                packed = encoder.encode(text)
                back = decode(pieces, memoryview(packed).cast("I"))
                rows.append((len(packed) // 4, zlib.crc32(packed), zlib.crc32(back.encode()), back == text))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_ids", "ids_crc32", "decoded_crc32", "exact"])

    return run


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, ids_crc32, decoded_crc32, exact.

    ids_crc32 is over the little-endian unsigned 32-bit ids, decoded_crc32 over the decoded text in
    UTF-8; exact says whether it is the text again, which only a text that holds the word mark itself
    can fail. A null text is empty: no ids, both checksums 0. Repeated rows repeat.
    """
    schema = "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, exact boolean"
    return documents(docs).mapInArrow(_round_trip(path or default_model()), schema)
