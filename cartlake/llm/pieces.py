"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice's boundaries are the places between characters; its edges are vocabulary pieces.
A piece may follow another only if merging the two of them by score gives just these two
again, which is the condition for byte-pair pieces; under it each boundary has exactly one
surviving path, so a back pointer is all that is kept. Only the last `longest piece` boundaries
can still be extended. Whenever the paths of all of them run through one boundary, the ids up
to it are committed and forgotten, so memory is bounded by the window and not by the text.
Since no piece continues over a space mark or has a line feed, paths meet there at once; ids of
such short stretches are remembered in a bounded table.

The model file is a parameter; its vocabulary (a size fixed by the model) goes to the tasks.

Results for odd input: null gives null, empty text gives no ids. Characters outside the
vocabulary become byte pieces. The character U+2581 is the model's own space mark, so it comes
back as a space, as in the library. Decoding ids outside the vocabulary is an error; byte runs
that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartlake.llm.common import per_batch, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Stretches that a table keeps, and the longest one worth keeping: longer ones rarely come again.
_REMEMBERED, _SHORT = 400_000, 20


class Vocabulary:
    """Pieces with ids and scores, and the search over them."""

    def __init__(self, pieces: list[tuple[str, float, str]]):
        self.pieces = pieces
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "piece"}
        self.scores = {p: s for p, s, kind in pieces if kind == "piece"}
        self.byte_ids = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        self.longest = max(map(len, self.ids), default=1)
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("a piece continues over a space mark or line feed")
        self.raw = [
            bytes([int(p[1:-1], 16)]) if kind == "byte" else p.replace(MARK, " ").encode() if kind == "piece" else b""
            for p, _, kind in pieces
        ]
        # Order in which merges happen, and the two parts each piece is merged from last.
        order = sorted({self.scores[p] for p in self.ids if len(p) > 1}, reverse=True)
        turn = {score: i for i, score in enumerate(order)}
        self.turn = {p: turn[self.scores[p]] if len(p) > 1 else -1 for p in self.ids}
        self.halves: dict[str, tuple[str, str]] = {}
        self.trie: dict = {}
        for piece in sorted(self.ids, key=len):
            if len(piece) > 1:
                halves = self.merged(piece, 2)
                if len(halves) != 2:
                    continue  # merging never makes it
                self.halves[piece] = (halves[0], halves[1])
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
        self._follows: dict[tuple[str, str], bool] = {}
        self._words: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self.packed = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.packed_bytes = {b: i.to_bytes(4, "little") for b, i in self.byte_ids.items()}

    def __reduce__(self):
        return Vocabulary, (self.pieces,)

    def merged(self, text: str, most: int = 1) -> list[str]:
        """A short text merged by best score, leftmost first, until no or `most` parts are left."""
        parts = list(text)
        while len(parts) > most:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        """Whether merging a and b side by side leaves both as they are.

        Merges are undone from the last one on; none across the place where a and b touch
        may come before the one just undone.
        """
        known = self._follows.get((a, b))
        if known is None:
            x, y, before, known = a, b, len(self.turn), True
            while True:
                across = self.turn.get(x + y)
                if across is not None and across < before:
                    known = False
                    break
                one, two = self.turn.get(x, -1), self.turn.get(y, -1)
                if one > two:
                    before, x = one, self.halves[x][1]
                elif two >= 0:
                    before, y = two + 1, self.halves[y][0]
                else:
                    break
            if len(self._follows) >= _REMEMBERED:
                self._follows.clear()
            self._follows[a, b] = known
        return known

    def stream(self, text: str) -> Iterator[str]:
        """Pieces of a text, committed as soon as all surviving paths agree."""
        longest, trie, follows = self.longest, self.trie, self.follows
        done = 0  # boundary up to which pieces are committed
        last = {0: ""}  # surviving piece that ends at each boundary from `done` on
        n = len(text)
        for begin in range(n):
            # All pieces that could end here have been tried; else the character is outside the vocabulary.
            before = last.get(begin)
            if before is None:
                before = last[begin] = text[begin - 1]
            if begin - done >= 4 * longest and begin % longest == 0:
                meet = self._meet(last, done, begin)
                if meet > done:
                    yield from self._path(last, done, meet)
                    for at in range(done, meet):
                        del last[at]
                    done = meet
            node = trie
            for end in range(begin, min(n, begin + longest)):
                node = node.get(text[end])
                if node is None:
                    break
                if "" in node and end + 1 not in last:
                    piece = node[""]
                    if not before or follows(before, piece):
                        last[end + 1] = piece
        if n and n not in last:
            last[n] = text[n - 1]
        yield from self._path(last, done, n)

    def _meet(self, last: dict[int, str], done: int, end: int) -> int:
        """The last boundary on the paths of all that can still be extended: `end` and those a piece reached beyond it."""
        live = {end, *(at for at in range(end + 1, end + self.longest) if at in last)}
        while len(live) > 1:
            at = max(live)
            live.remove(at)
            live.add(max(done, at - len(last[at])))
        return live.pop()

    @staticmethod
    def _path(last: dict[int, str], done: int, end: int) -> list[str]:
        out = []
        while end > done:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _short(self, text: str) -> list[str]:
        """The same search for a stretch that is shorter than the window is worth keeping for."""
        trie, memo, n = self.trie, self._follows, len(text)
        last: list[str | None] = [None] * (n + 1)
        last[0] = ""
        for begin in range(n):
            before = last[begin]
            if before is None:
                before = last[begin] = text[begin - 1]
            node, end = trie, begin
            for c in text[begin:]:
                node = node.get(c)
                if node is None:
                    break
                end += 1
                if "" in node and last[end] is None:
                    piece = node[""]
                    if begin:
                        fits = memo.get((before, piece))
                        if fits is None:
                            fits = self.follows(before, piece)
                        if not fits:
                            continue
                    last[end] = piece
        out, end = [], n
        if n and last[n] is None:
            last[n] = text[n - 1]
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def _search(self, text: str) -> bytes:
        """Ids as bytes of 32-bit integers."""
        known = self.packed
        out = []
        for piece in self._short(text) if len(text) <= 64 else self.stream(text):
            found = known.get(piece)
            out.append(found if found is not None else b"".join(self.packed_bytes[b] for b in piece.encode("utf-8", "replace")))
        return b"".join(out)

    def _kept(self, table: dict[str, bytes], text: str, ids: bytes) -> bytes:
        if len(text) <= _SHORT:
            if len(table) >= _REMEMBERED:
                table.clear()
            table[text] = ids
        return ids

    def part(self, text: str) -> bytes:
        """Ids of a stretch without line feeds whose only space marks lead it."""
        known = self._parts.get(text)
        return known if known is not None else self._kept(self._parts, text, self._search(text))

    def word(self, text: str) -> bytes:
        """Ids of a space mark and the text up to the next one."""
        if "\n" not in text:
            return self._kept(self._words, text, self._search(MARK + text))
        first, *rest = text.split("\n")
        known = [self._words.get(first) or self.word(first) if first else self.part(MARK)]
        for x in rest:
            known += (self.packed_bytes[10], self.part(x))
        return b"".join(known)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            get, word = self._words.get, self.word
            out = [get(w) or word(w) for w in words]
        else:
            out, marks = [], 0
            for w in words:
                marks += 1
                if w:
                    first, *rest = w.split("\n")
                    out.append(self.part(MARK * marks + first))
                    for x in rest:
                        out += (self.packed_bytes[10], self.part(x))
                    marks = 0
            if marks:
                out.append(self.part(MARK * marks))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        if len(ids) and (min(ids) < 0 or max(ids) >= len(self.raw)):
            raise ValueError("id outside the vocabulary")
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: "byte" if model.is_byte(i) else "other" if model.is_control(i) or model.is_unknown(i) else "piece"
    return Vocabulary([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.vocab_size())])


def _lists(rows: list[np.ndarray | None]) -> pa.Array:
    sizes = [0 if x is None else len(x) for x in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    values = np.concatenate([x for x in rows if x is not None] or [np.zeros(0, np.int32)])
    mask = pa.array([x is None for x in rows])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=mask)


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids): the piece ids of every whole text."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def work(batch):
        vocab = sent.value
        rows = [None if t is None else vocab.encode(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(rows)], ["doc_id", "ids"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return given.mapInArrow(per_batch(work), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, text): the piece ids of every whole text, and the text decoded from these ids.

    The same as `decode(encode(docs))` in one step, so a task needs one Python worker and one vocabulary.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def work(batch):
        vocab = sent.value
        rows = [None if t is None else vocab.encode(t) for t in batch.column("text").to_pylist()]
        texts = [None if x is None else vocab.decode(x.tolist()) for x in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), _lists(rows), pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
        )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return given.mapInArrow(per_batch(work), "doc_id long, ids array<int>, text string")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, text): the texts the ids stand for."""
    spark = encoded.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(vocabulary)

    def work(batch):
        vocab, ids = sent.value, batch.column("ids")
        texts = [None if not x.is_valid else vocab.decode(x.values.to_numpy().tolist()) for x in ids]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(per_batch(work), "doc_id long, ids array<int>, text string")
