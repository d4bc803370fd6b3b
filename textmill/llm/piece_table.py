"""SentencePiece byte-pair encoding by a table of each prefix's last token, and decoding.

In byte-pair encoding every prefix of a text has exactly one last token: the encoding of a text
is the one row of tokens in which each two neighbours are compatible, that is, encoding their
joined characters gives the two again. So the table of a text is filled from left to right: an
automaton names all tokens that end at a place, and the one that is compatible with the last
token of the prefix before it is stored. The ids are then read backwards from the end. No merge
is replayed, and the cost follows the length of the text whatever the merges are.

Two tokens are tested by taking their merges back, latest first, and looking whether the two
symbols that meet at the seam would have been merged before either of them was used up. Of
equal scores the merge further left comes first.

Texts are cut between Latin letters and other characters and before spaces, where no token of the
vocabulary reaches across (checked when it is loaded), and each task keeps the ids of pieces it
has met, at most twice ``HELD`` of them. Characters without a token are given as their bytes.

Executors get the vocabulary with the function (about 1 MB); its file is read by the driver.

Defined results: a null text is encoded like an empty one, to no ids; null ids decode to a null
text, and so do ids outside the vocabulary or a null among them. Repeated rows each get a row.
Columns other than the one that is read pass through untouched; one with the name of the output
is replaced.
"""

import codecs
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HELD = 200_000  # distinct pieces of text in a task's memory, twice over
_TESTED = 500_000  # pairs of tokens
_SHORT = 48  # characters of a piece that is worth keeping
_SPACE = "▁"
_UNKNOWN = " ⁇ "
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏḀ-ỿ"
_PIECES = re.compile(f" *[{_LATIN}]+| *[^ {_LATIN}]+| +")
_ONE_KIND = re.compile(f"[{_LATIN}]*|[^{_LATIN}{_SPACE}]*")
_PROBES = ("", " ", "a  b ", "\n\t", "ﬁ½　é", "\u0000", "<s>", _SPACE, "\U0010ffff x", "    y")


@dataclass(frozen=True)
class Vocabulary:
    """The tokens of a model by id. ``kinds`` has n (plain), b (byte), c (control), u (unknown)."""

    tokens: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str

    @staticmethod
    def load(path: str) -> "Vocabulary":
        """Read a model file. One with another algorithm or with normalising rules is refused."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        kinds = "".join(
            "b" if model.is_byte(i) else "c" if model.is_control(i) else "u" if model.is_unknown(i) else "n" for i in ids
        )
        own = Vocabulary(tuple(map(model.id_to_piece, ids)), tuple(map(model.get_score, ids)), kinds)
        plain = [t.lstrip(_SPACE) for t, kind in zip(own.tokens, kinds, strict=True) if kind == "n"]
        if kinds.count("b") != 256 or not all(_ONE_KIND.fullmatch(t) for t in plain):
            raise ValueError("the model must have byte tokens, and Latin letters apart from other characters")
        for probe in _PROBES:
            if encoder(own).ids(probe) != model.encode(probe, num_threads=1):
                raise ValueError("not a byte-pair model without normalising rules")
        return own


class _Encoder:
    def __init__(self, vocabulary: Vocabulary):
        plain = [i for i, kind in enumerate(vocabulary.kinds) if kind == "n"]
        shown = [t.replace(_SPACE, " ") for t in vocabulary.tokens]
        token = {shown[i]: i for i in plain}
        self.length = [len(t) for t in vocabulary.tokens]
        self.byte = [0] * 256
        for i, kind in enumerate(vocabulary.kinds):
            if kind == "b":
                self.byte[int(vocabulary.tokens[i][1:-1], 16)] = i
        # when a token is merged: 1 for the best score; single characters are there from the start
        order = {s: k for k, s in enumerate(sorted({vocabulary.scores[i] for i in plain}, reverse=True), 1)}
        self.time = [0] * len(vocabulary.tokens)
        for i in plain:
            if self.length[i] > 1:
                self.time[i] = order[vocabulary.scores[i]]
        self.never = len(order) + 2
        # the two parts each token is last merged from, and the token that two parts give
        self.left, self.right = list(range(len(vocabulary.tokens))), list(range(len(vocabulary.tokens)))
        self.joined: dict[tuple[int, int], int] = {}
        reachable = {i for i in plain if self.length[i] == 1}
        for i in sorted((i for i in plain if self.length[i] > 1), key=lambda i: (self.time[i], self.length[i])):
            text, found = shown[i], False
            for k in range(1, len(text)):
                a, b = token.get(text[:k]), token.get(text[k:])
                if a is None or b is None:
                    continue
                self.joined[a, b] = i
                if not found and a in reachable and b in reachable and self._meet(a, b, self.time[i]):
                    self.left[i], self.right[i], found = a, b, True
            if found:
                reachable.add(i)
        self.automaton = ahocorasick.Automaton()
        for i in reachable:
            self.automaton.add_word(shown[i], (self.length[i], i))
        self.automaton.make_automaton()
        self.tested: dict[int, bool] = {}  # first token times the vocabulary's size plus second token
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _meet(self, a: int, b: int, before: int) -> bool:
        """Whether no merge earlier than ``before`` joins the last part of a to the first of b."""
        time, joined = self.time, self.joined
        while True:
            both = joined.get((a, b))
            if both is not None and time[both] < before:
                return False
            # take back the later of the two; of equal ones the right one is later
            if time[b] >= time[a]:
                if not time[b]:
                    return True
                before, b = time[b] + 1, self.left[b]  # a merge at the seam is further left
            else:
                before, a = time[a], self.right[a]

    def _encode(self, text: str) -> list[int]:
        place, size, tested = len(text), len(self.length), self.tested
        last = [-1] * (place + 1)  # the last token of each prefix; -1 after a character without one
        for end, (length, token) in self.automaton.iter(text):
            if last[end + 1] >= 0:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                pair = before * size + token
                fine = tested.get(pair)
                if fine is None:
                    if len(tested) >= _TESTED:
                        tested.clear()
                    fine = tested[pair] = self._meet(before, token, self.never)
                if not fine:
                    continue
            last[end + 1] = token
        out = []
        while place:
            if last[place] < 0:
                out += [self.byte[b] for b in reversed(text[place - 1].encode())]
                place -= 1
            else:
                out.append(last[place])
                place -= self.length[last[place]]
        out.reverse()
        return out

    def _piece(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = array("i", self._encode(text)).tobytes()
        if len(text) <= _SHORT:
            if len(self.held) >= HELD:  # what is met again moves on, the rest goes with the next change
                self.held, self.older = {}, self.held
            self.held[text] = found
        return found

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers."""
        if not text:
            return b""
        make = self._piece
        parts = _PIECES.findall(" " + text.replace(_SPACE, " "))
        return b"".join([self.held.get(p) or make(p) for p in parts])

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


@lru_cache(maxsize=2)
def encoder(vocabulary: Vocabulary) -> _Encoder:
    return _Encoder(vocabulary)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of a text as ARRAY<INT>."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(vocabulary)
        for texts in batches:
            rows = [own.packed(t.as_py() or "") for t in texts]
            ends = np.cumsum([0, *map(len, rows)]) // 4
            values = pa.array(np.frombuffer(b"".join(rows), np.int32))
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)

    return docs.withColumn(out, ids(F.col(text)))


def _next_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


class _Decoder:
    """A byte that is no part of a character becomes one U+FFFD; a space at the start goes."""

    def __init__(self, vocabulary: Vocabulary):
        codecs.register_error("textmill-byte", _next_byte)
        self.kinds = vocabulary.kinds
        self.shown = [
            bytes([int(t[1:-1], 16)]) if k == "b" else b"" if k == "c" else _UNKNOWN.encode() if k == "u" else t.replace(_SPACE, " ").encode()
            for t, k in zip(vocabulary.tokens, vocabulary.kinds, strict=True)
        ]
        self.control = {i for i, k in enumerate(vocabulary.kinds) if k == "c"}

    def text(self, ids: list[int] | None) -> str | None:
        if ids is None or any(i is None or not 0 <= i < len(self.shown) for i in ids):
            return None
        shown = self.shown
        if self.control.isdisjoint(ids):
            parts = [ids]
        else:  # a control token ends a run of bytes
            cuts = [k for k, i in enumerate(ids) if i in self.control]
            parts = [ids[a + 1 : b] for a, b in zip([-1, *cuts], [*cuts, len(ids)], strict=True)]
        out = "".join(b"".join([shown[i] for i in part]).decode(errors="textmill-byte") for part in parts)
        first = next((i for i in ids if i not in self.control), None)
        if first is not None and self.kinds[first] == "n" and shown[first][:1] == b" ":
            return out[1:]
        return out


@lru_cache(maxsize=2)
def decoder(vocabulary: Vocabulary) -> _Decoder:
    return _Decoder(vocabulary)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text that the ids stand for."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = decoder(vocabulary)
        for rows in batches:
            yield pa.array([own.text(row.as_py()) for row in rows], pa.string())

    return encoded.withColumn(out, text(F.col(ids)))


_DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, text by text."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, back = encoder(vocabulary), decoder(vocabulary)
        names = [str(i) for i in range(len(vocabulary.tokens))]
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = coder.ids(text.as_py() or "")
                counts.append(len(ids))
                coded.append(sha256(",".join([names[i] for i in ids]).encode()).hexdigest())
                decoded.append(sha256(back.text(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digests, _DIGESTS)
