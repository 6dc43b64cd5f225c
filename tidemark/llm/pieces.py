"""Encoding and decoding by merge-type SentencePiece vocabularies."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.packing import Kept
from tidemark.llm.text import documents, sliced

_SPACE = "▁"
#: Bits of an agenda entry that hold a place in the text.
_PLACE = (1 << 32) - 1
#: Byte pieces that are no UTF-8 decode to one replacement character a byte.
codecs.register_error("one_a_byte", lambda e: ("�" * (e.end - e.start), e.end))


class Pieces:
    """A merge-type vocabulary: encodes by its own agenda of symbol pairs, decodes by its own table of pieces.

    encode and decode give what the sentencepiece library gives, without sampling;
    the library itself normalizes texts and is at hand as .library to check against.
    """

    def __init__(self, path: str, room: int = 600_000):
        from sentencepiece import SentencePieceProcessor

        self.library = m = SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        inside = [i for i in ids if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i))]
        self.begin, self.end = m.bos_id(), m.eos_id()
        if any(m.is_unused(i) for i in ids):
            raise ValueError("the vocabulary has unused pieces")
        self.packed = {m.id_to_piece(i): i.to_bytes(4, "little") for i in inside}
        order = {score: at for at, score in enumerate(sorted({m.get_score(i) for i in inside}, reverse=True))}
        self.ranks = {m.id_to_piece(i): order[m.get_score(i)] * (_PLACE + 1) for i in inside}
        self.byte_ids = {int(m.id_to_piece(i)[1:-1], 16): i for i in ids if m.is_byte(i)}
        self.unknown = m.unk_id()
        # Pairs of characters that some piece holds side by side. Symbols never merge across any other pair.
        self.inner = {pair for piece in self.packed for pair in map(add, piece, piece[1:])}
        # Where no piece goes on past a word's end with a space mark, words and the marks before them are encoded apart.
        self.apart = all(pair[1] != _SPACE or pair[0] == _SPACE for pair in self.inner) and m.normalize("a") == f"{_SPACE}a"
        self.words = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+" if self.apart else r"(?s).+")
        self.fresh: dict[str, bytes] = {}
        self.known = Kept(self._looked_up, room)
        self.surfaces = np.array([self._surface(i) for i in ids], object)

    def merged(self, text: str) -> list[str]:
        """The pieces of text: the pair of adjacent symbols with the best score is merged first, of equals the leftmost.

        The agenda is a heap of numbers: a pair's rank by score, and where its left
        symbol begins. live holds the one entry of each left symbol that counts, so
        that entries whose symbols have changed since are found out when taken.
        """
        n, rank_of = len(text), self.ranks.get
        symbols, live = list(text), [-1] * n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i, both in enumerate(map(add, text, text[1:])):
            if (rank := rank_of(both)) is not None:
                live[i] = rank | i
                agenda.append(rank | i)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & _PLACE
            if live[left] != entry:
                continue
            right = after[left]
            symbols[left] = both = symbols[left] + symbols[right]
            symbols[right] = ""
            live[left] = live[right] = -1
            after[left] = far = after[right]
            if far < n:
                before[far] = left
                if (rank := rank_of(both + symbols[far])) is not None:
                    live[left] = rank | left
                    heappush(agenda, rank | left)
            near = before[left]
            if near >= 0:
                live[near] = -1
                if (rank := rank_of(symbols[near] + both)) is not None:
                    live[near] = rank | near
                    heappush(agenda, rank | near)
        return [s for s in symbols if s]

    def _id_bytes(self, piece: str) -> bytes:
        """A symbol outside the vocabulary is its UTF-8 bytes where the vocabulary has pieces for them."""
        found = self.packed.get(piece)
        if found is not None:
            return found
        if not self.byte_ids:
            return self.unknown.to_bytes(4, "little")
        return b"".join(self.byte_ids[b].to_bytes(4, "little") for b in piece.encode())

    def _looked_up(self, word: str) -> bytes:
        """The ids of a word seen for the first time. Parts that no piece joins are words of their own."""
        cuts = [i for i, pair in enumerate(map(add, word, word[1:]), 1) if pair not in self.inner]
        if cuts:
            ids = b"".join([self.known[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)])])
        else:
            ids = b"".join(map(self._id_bytes, self.merged(word)))
        if word[0] == _SPACE != word:
            self.fresh[word] = ids
        return ids

    def encoded(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers, with the begin and the end id."""
        words = self.words.findall(self.library.normalize(text))
        return b"".join([self.begin.to_bytes(4, "little"), *map(self.known.__getitem__, words), self.end.to_bytes(4, "little")])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoded(text), "<u4").tolist()

    def _surface(self, i: int) -> bytes:
        m = self.library
        if m.is_control(i):
            return b""
        if m.is_unknown(i):
            return " ⁇ ".encode()
        piece = m.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if m.is_byte(i) else piece.replace(_SPACE, " ").encode()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids. The space mark that normalizing put before the text is taken off the first piece."""
        parts = self.surfaces[ids].tolist()
        first = next((i for i, part in enumerate(parts) if part), None)
        if first is not None and parts[first][:1] == b" " and self.library.id_to_piece(int(ids[first])).startswith(_SPACE):
            parts[first] = parts[first][1:]
        return b"".join(parts).decode("utf-8", "one_a_byte")


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The vocabulary of this Python worker, which keeps what it has encoded from task to task."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def checked(pieces: Pieces, texts: list[str]) -> Iterator[tuple[bytes, str]]:
    """(ids as bytes, decoded text) of each text, held against the library; a difference is an error.

    Where the vocabulary lets words be encoded apart, the library encodes every
    word that is not yet known from an earlier batch, else whole texts. It decodes
    the ids of every whole text.
    """
    made = [pieces.encoded(text) for text in texts]
    if pieces.apart:
        theirs = pieces.library.encode([word[1:].replace(_SPACE, " ") for word in pieces.fresh], num_threads=1)
        ours: Iterable[bytes] = pieces.fresh.values()
    else:
        theirs, ours = pieces.library.encode(texts, add_bos=True, add_eos=True, num_threads=1), made
    if [len(x) // 4 for x in ours] != [len(x) for x in theirs] or b"".join(ours) != np.fromiter(chain.from_iterable(theirs), "<u4").tobytes():
        pieces.known.clear()
        pieces.known.old.clear()
        pieces.fresh.clear()
        raise ValueError("the ids of a batch differ from the library's")
    pieces.fresh.clear()
    for ids in made:
        numbers = np.frombuffer(ids, "<u4")
        decoded = pieces.decode(numbers)
        if decoded != pieces.library.decode(numbers.tolist()):
            raise ValueError("the decoding of a text differs from the library's")
        yield ids, decoded


def encoded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded): the ids of every whole text as little-endian unsigned 32-bit numbers, and the text they decode to.

    Null and empty texts are the begin and the end id, and decode to an empty text.
    Rows are rows: repeated ones come out repeated, null ids stay null, an empty
    table gives an empty one; other columns are left behind. No row is exchanged.
    """
    return _mapped(docs, vocabulary, "doc_id bigint, ids binary, decoded string", lambda ids, text: (ids, text), [pa.binary(), pa.string()])


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of what encoded gives, made in the task that encodes."""

    def row(ids: bytes, text: str) -> tuple[int, str, str]:
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _mapped(docs, vocabulary, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row, [pa.int64(), pa.string(), pa.string()])


def _mapped(docs: DataFrame, vocabulary: str, schema: str, row, kinds: list[pa.DataType]) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = loaded(vocabulary)
        for batch in sliced(batches, 128):
            rows = [row(*made) for made in checked(pieces, batch.column("text").to_pylist())]
            if rows:
                yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)

    return documents(docs).mapInArrow(work, schema)
