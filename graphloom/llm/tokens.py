"""Token ids of whole texts with a public tokenizer file.

The tokenizers library does the encoding. Its pre-tokenizers cut a text into pieces which its
model then encodes one by one, so each distinct piece is encoded once and remembered. Many texts
are cut side by side, as one array of characters, and only the distinct pieces among them are
looked up. Texts with letters or white space outside the plain alphabet below, and those that hold
the string of a token that was added to the vocabulary, go through the library's whole pipeline.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa

# How the two public pre-tokenizers cut text, for ASCII and the letters of Latin-1.
PLAIN = bytes([10, *range(32, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
#: Longer pieces are encoded anew each time, so that the number of those kept bounds their size.
LONGEST = 64
#: Texts are cut side by side up to so many characters, or one by one if they are longer.
CHARS = 1 << 22
GAPS = (b"  ", b" \n", b"\n ", b"\n\n")
#: Classes of characters: 0 stands for the end of a text.
END, SPACE, LINE, LETTER, DIGIT, OTHER = range(6)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[0, 32, 10]] = END, SPACE, LINE
CLASS[list(range(48, 58))] = DIGIT
CLASS[[*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = LETTER
LOWER = bytes(ord(chr(b).lower()) if b in PLAIN else b for b in range(256))
#: What may follow an apostrophe as a piece with it.
SHORT = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _plain(raw: bytes, kind: str) -> bool:
    """Whether the pieces below are those of the library. Byte-level pieces also need single gaps."""
    if raw.translate(None, PLAIN):
        return False
    return kind == "word" or not (raw[-1] in b" \n" or any(g in raw for g in GAPS))


def _starts(chars: np.ndarray, kind: str) -> np.ndarray:
    """Where pieces start in plain texts that each end with a 0, which is a piece too.

    ``'s|'t|'re|'ve|'m|'ll|'d|[letters]+|[digit]|[other]+`` for words, where white space makes
    pieces of its own; for bytes with a space before each, all digits at once, and single line ends.
    """
    of = CLASS[chars]
    start = np.empty(len(of), bool)
    start[:1] = True
    np.not_equal(of[1:], of[:-1], out=start[1:])
    if kind == "word":
        start |= of == DIGIT
    else:
        start[1:] &= of[:-1] != SPACE  # a space goes with what follows
    start |= of == END
    quotes = np.flatnonzero((chars == 39) & start)
    if len(quotes):
        near = [np.append(chars, [0, 0])[quotes + k] for k in (1, 2)]
        for end in SHORT:
            at = quotes[np.logical_and.reduce([near[k] == c for k, c in enumerate(end)])]
            start[at + 1] = False
            start[at + 1 + len(end)] = True
    return np.flatnonzero(start)


def _byte_letters() -> np.ndarray:
    """The printable stand-in of each byte, as byte-level vocabularies write it; 0 stays."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    out = np.arange(256, dtype="<u4")
    out[rest] = 256 + np.arange(len(rest))
    out[0] = 0
    return out


SPELLED = _byte_letters()


class Encoder(dict):
    """ids of texts, as little-endian unsigned 32-bit bytes. It remembers pieces as a dictionary.

    path: a tokenizer file of byte-level kind (kind="byte") or word kind (kind="word": lower
    case, white space dropped). remember: how many pieces are kept, about, in two generations, of
    which the older goes; this bounds memory and changes no result. Long pieces are not kept.
    """

    def __init__(self, path: str, kind: str, remember: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        added = self.whole.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        self.folds = any(t.normalized for t in added)  # then what a text is normalized to may hold one, too
        self.kind, self.most, self.older = kind, remember // 2, {}
        self.tokenize = self.whole.model.tokenize

    def look_up(self, pieces: list[bytes]) -> list[bytes]:
        """ids of distinct pieces; what is not remembered is encoded and learned."""
        told = list(map(self.get, pieces))
        if None not in told:
            return told
        new = []
        for k in (k for k, ids in enumerate(told) if ids is None):
            told[k] = self.older.get(pieces[k])
            if told[k] is None:
                new.append(k)
            elif len(pieces[k]) <= LONGEST:
                self[pieces[k]] = told[k]
        spelled = b"\0".join([pieces[k] for k in new]).decode("latin-1").encode()
        ids, end, tokenize = [], 0, self.tokenize
        ends = []
        for piece in SPELLED[np.frombuffer(spelled, np.uint8)].tobytes().decode("utf-32-le").split("\0") if new else ():
            ids += [t.id for t in tokenize(piece)]
            ends.append(4 * len(ids))
        raw = array("I", ids).tobytes()
        for k, z in zip(new, ends, strict=True):
            told[k], end = raw[end:z], z
            if len(pieces[k]) <= LONGEST:
                self[pieces[k]] = told[k]
        return told

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """One bytes object for each text; null counts as empty."""
        ids, sizes = self.encode_all(texts)
        raw, ends = ids.tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]

    def encode_all(self, texts: list[str | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has, ``end`` added to each."""
        parts, raws, odd, chars = [], [], [], 0
        for text in texts:
            if raws and chars + len(text or "") > CHARS:
                parts.append(self._stretch(raws, odd, end))
                raws, odd, chars = [], [], 0
            raw = self._raw(text) if text else b""
            if raw is None:
                odd.append((len(raws), text))
            raws.append(raw or b"")
            chars += len(text or "") + 1
        if raws:
            parts.append(self._stretch(raws, odd, end))
        ids, sizes = zip(*parts, strict=True) if parts else ([np.zeros(0, "<u4")], [np.zeros(0, np.int64)])
        return np.concatenate(ids), np.concatenate(sizes)

    def _stretch(self, raws: list[bytes], odd: list[tuple[int, str]], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same of plain texts; odd texts take the library's ids, and have an empty one at their place."""
        ids, sizes = self._side_by_side(raws, end)
        if not odd:
            return ids, sizes
        begins, parts, at = np.cumsum(sizes) - sizes, [], 0
        for k, text in odd:
            own = np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
            parts += [ids[at : begins[k]], own]
            at = begins[k]
            sizes[k] += len(own)
        return np.concatenate([*parts, ids[at:]]), sizes

    def _raw(self, text: str) -> bytes | None:
        """A plain text in Latin-1, else None."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        return None if not _plain(raw, self.kind) or self.folds or any(a in text for a in self.added) else raw

    def _side_by_side(self, raws: list[bytes], end: bytes) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        data = b"\0".join([*raws, b""])
        if self.kind == "word":
            data = data.translate(LOWER)
        chars = np.frombuffer(data, np.uint8)
        start = _starts(chars, self.kind)
        offsets = np.append(start, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        pieces = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        last = pieces.index(b"\0")
        pieces[last] = b""
        if self.kind == "word":
            pieces = [b"" if p.isspace() else p for p in pieces]
        told = self.look_up(pieces)
        told[last] = end
        which = found.indices.to_numpy()
        size = np.fromiter(map(len, told), np.int32, len(told)) // 4
        first = np.cumsum(size, dtype=np.int64) - size
        many = size[which]
        before = np.cumsum(many, dtype=np.int64)
        ids = np.frombuffer(b"".join(told), "<u4")[np.repeat(first[which] - before + many, many) + np.arange(before[-1])]
        total = before[chars[start] == 0]
        return ids, np.diff(total, prepend=0)
