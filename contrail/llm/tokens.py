"""Token ids of whole texts, column by column: each distinct pre-token is encoded once and then looked up.

A byte-level BPE encodes each pre-token by itself, so a text's ids are those of its pre-tokens put together. Where pre-tokens
begin is worked out for all texts of a block at once, on their UTF-8 bytes; what kind of character a code point is, is
asked of the tokenizer's own pre-tokenizer. Arrow's dictionary encoding finds the distinct pre-tokens of a block, and every id
comes from the tokenizers library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Kinds of characters: letters, digits, the blank, other white space, and everything else.
LETTER, DIGIT, OTHER, BLANK, SPACE = range(5)
#: Bytes of text that are worked on at a time; a longer text is cut before a blank.
BLOCK = 2 << 20
#: Bytes of the longest pre-tokens that are looked up; longer ones are encoded each time.
LONGEST = 64
#: Powers of two odd bases.
POWERS = [np.cumprod(np.full(LONGEST + 1, x, dtype=np.uint64), dtype=np.uint64) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)]
#: A blank before a printable ASCII sign always begins a pre-token.
SAFE = re.compile(rb" [!-~]")
#: What an apostrophe makes one pre-token with, by the usual pattern of byte-level vocabularies.
SHORT, LONG = b"stmd", (b"re", b"ve", b"ll")


def byte_letters() -> str:
    """The letter that byte-level vocabularies write for each byte, by position: printable Latin-1 signs
    stand for themselves, the others for 256 and up in order."""
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return "".join(out)


class Kinds:
    """The kind of each code point, as the pre-tokenizer has it; asked once for each that occurs."""

    def __init__(self, pre_tokenizer):
        self.split = pre_tokenizer.pre_tokenize_str
        self.table = np.full(0x110000, 255, dtype=np.uint8)
        self.ascii = self.of(np.arange(256))
        self.ascii[128:] = OTHER

    def _ask(self, c: str) -> int:
        if c == " ":
            return BLANK
        if len(self.split("a" + c)) == 1:
            return LETTER
        if len(self.split("1" + c)) == 1:
            return DIGIT
        # a run of white space before a letter leaves its last sign to stand alone, other signs stay together
        return SPACE if len(self.split(c + c + "a")) == 3 else OTHER

    def of(self, codes: np.ndarray) -> np.ndarray:
        found = self.table[codes]
        if (found == 255).any():
            for k in np.unique(codes[found == 255]).tolist():
                self.table[k] = self._ask(chr(k))
            found = self.table[codes]
        return found


def begins(data: np.ndarray, firsts: np.ndarray, kinds: Kinds) -> np.ndarray:
    """The places where pre-tokens begin in data, the UTF-8 bytes of texts of which one starts at each of firsts (ascending, all
    within data)."""
    n = len(data)
    kind = kinds.ascii[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.append(data, np.zeros(3, dtype=np.uint8)).astype(np.int32)
        b = padded[lead]
        two, three, four = lead[b < 0xE0], lead[(b >= 0xE0) & (b < 0xF0)], lead[b >= 0xF0]
        for at, size in ((two, 2), (three, 3), (four, 4)):
            code = padded[at] & (0xFF >> size + 1)
            for k in range(1, size):
                code = code << 6 | padded[at + k] & 0x3F
            found = kinds.of(code)
            for k in range(size):
                kind[at + k] = found
    white = kind >= BLANK
    group = np.minimum(kind, BLANK)
    new = np.empty(n, dtype=bool)
    np.not_equal(group[1:], group[:-1], out=new[1:])
    new[firsts] = True
    starts_text = np.zeros(n + 1, dtype=bool)
    starts_text[firsts] = True
    # the last sign of white space before something else: a blank joins what follows, another stands alone
    after = np.flatnonzero(white[:-1] & ~white[1:] & ~starts_text[1:n]) + 1
    joins = kind[after - 1] == BLANK
    new[after[joins]] = False
    new[after[joins] - 1] = True
    last = after[~joins] - 1
    while len(last):
        inner = data[last] & 0xC0 == 0x80
        new[last[~inner]] = True
        last = last[inner] - 1
    # 's, 't, 're and so on, where the apostrophe begins a pre-token
    mark = np.flatnonzero(data[:-1] == 39) if n else np.empty(0, dtype=np.int64)
    mark = mark[new[mark] & ~starts_text[mark + 1]]
    if len(mark):
        one = np.isin(data[mark + 1], np.frombuffer(SHORT, dtype=np.uint8))
        two = np.zeros(len(mark), dtype=bool)
        far = np.minimum(mark + 2, n - 1)
        for x, y in LONG:
            two |= (data[mark + 1] == x) & (data[far] == y)
        two &= (mark + 2 < n) & ~starts_text[np.minimum(mark + 2, n)] & ~one
        for at, size in ((mark[one], 2), (mark[two], 3)):
            new[at + 1] = False
            end = at + size
            new[end[end < n]] = True
    del kind, white, group, starts_text
    return np.flatnonzero(new).astype(np.int32)


def hashed(parts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each part: polynomials of its bytes modulo 2^64 in two odd bases, mixed with its length."""
    n = len(parts)
    offsets = np.frombuffer(parts.buffers()[1], dtype=np.int32)[parts.offset : parts.offset + n + 1]
    data = np.frombuffer(parts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64) + np.uint64(1)
    starts, size = offsets[:-1] - offsets[0], np.diff(offsets)
    within = np.arange(len(data), dtype=np.int32) - np.repeat(starts, size)
    np.minimum(within, LONGEST, out=within)  # longer parts aren't looked up
    out = []
    for powers in POWERS:
        h = np.add.reduceat(data * powers[within], starts) if n else np.empty(0, dtype=np.uint64)
        h = (h ^ size.astype(np.uint64) ^ h >> np.uint64(31)) * POWERS[0][1]
        out.append(h ^ h >> np.uint64(29))
    return out[0], out[1]


class Cache:
    """Ids of pre-tokens by 128 bits of hashes, at most `keep` of them and those of one block: 28 bytes each beside the ids, in sorted arrays, the newest
    apart until they are many. When it is full it forgets all but the newest."""

    def __init__(self, make, keep: int):
        self.make, self.keep = make, keep
        self.levels = [self._none(), self._none()]
        self.flat, self.used = np.empty(1 << 16, dtype=np.uint32), 0

    @staticmethod
    def _none() -> tuple[np.ndarray, ...]:
        return tuple(np.empty(0, dtype=t) for t in (np.uint64, np.uint64, np.int32, np.int32))

    def __len__(self) -> int:
        return sum(len(x[0]) for x in self.levels)

    def _add(self, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where in flat the ids of each part begin, and their number."""
        size = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
        new = np.fromiter((x for part in ids for x in part), dtype=np.uint32, count=int(size.sum()))
        if self.used + len(new) > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.empty(self.used + 2 * len(new), dtype=np.uint32)))
        self.flat[self.used : self.used + len(new)] = new
        begin = self.used + np.cumsum(size, dtype=np.int32) - size
        self.used += len(new)
        return begin.astype(np.int32), size

    def _forget(self) -> None:
        """Keep the newest level only, or nothing where that is all there is."""
        h, g, begin, size = self.levels[1] if len(self.levels[0][0]) else self._none()
        total = np.cumsum(size, dtype=np.int32)
        take = np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0, dtype=np.int32)
        ids = self.flat[take]
        self.flat, self.used = np.concatenate((ids, np.empty(1 << 16, dtype=np.uint32))), len(ids)
        self.levels = [(h, g, (total - size).astype(np.int32), size), self._none()]

    def find(self, parts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in flat of the ids of distinct parts; those that are missing are made."""
        n = len(parts)
        if len(self) > self.keep:
            self._forget()
        h, g = hashed(parts)
        begin, size, missing = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32), np.ones(n, dtype=bool)
        for known in self.levels:
            if len(known[0]):
                at = np.minimum(np.searchsorted(known[0], h), len(known[0]) - 1)
                hit = (known[0][at] == h) & (known[1][at] == g) & missing
                begin[hit], size[hit] = known[2][at[hit]], known[3][at[hit]]
                missing &= ~hit
        long = pc.binary_length(parts).to_numpy() > LONGEST
        missing |= long
        new = np.flatnonzero(missing)
        if len(new):
            begin[new], size[new] = self._add([self.make(x) for x in parts.take(pa.array(new)).to_pylist()])
            new = new[~long[new]]
            grown = [np.concatenate((x, y[new])) for x, y in zip(self.levels[1], (h, g, begin, size))]
            if len(grown[0]) > self.keep // 8:
                grown, self.levels[1] = [np.concatenate(x) for x in zip(self.levels[0], grown)], self._none()
                level = 0
            else:
                level = 1
            by = np.argsort(grown[0], kind="stable")
            self.levels[level] = tuple(x[by] for x in grown)
        return begin, size


class Encoder:
    """Ids of texts by a tokenizers JSON file, without the special tokens that a post-processor adds.

    Texts that hold one of the vocabulary's added tokens go to the library whole, as do all texts of tokenizers of another build than plain
    byte-level BPE. special_as_text: added tokens in a text are ordinary text. See Cache for keep.
    """

    def __init__(self, path: str, keep: int = 1_000_000, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.letters, self.cache, self.model = byte_letters(), Cache(self._part, keep), self.tokenizer.model.tokenize
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [x.content for x in added if not (special_as_text and x.special)]
        pre = self.tokenizer.pre_tokenizer
        state = pre.__getstate__() if pre is not None else b""
        plain = all(x in state for x in (b'"ByteLevel"', b'"use_regex":true', b'"add_prefix_space":false')) and self.tokenizer.normalizer is None
        self.kinds = Kinds(pre) if plain else None

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _part(self, part: str) -> list[int]:
        """Ids of one pre-token."""
        mapped = part.encode().decode("latin-1").translate(self.letters)
        return [x.id for x in self.model(mapped)]

    def _block(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number up to each of firsts): of texts of which one starts at each of firsts."""
        n = len(data)
        if not n:
            return np.empty(0, dtype=np.uint32), np.zeros(len(firsts), dtype=np.int64)
        at = begins(data, np.unique(firsts[firsts < n]), self.kinds)
        parts = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, np.int32(n))), pa.py_buffer(data)]).dictionary_encode()
        begin, size = self.cache.find(parts.dictionary)
        number = parts.indices.to_numpy()
        del parts
        begin, size = begin[number], size[number]
        total = np.zeros(len(number) + 1, dtype=np.int32)
        np.cumsum(size, out=total[1:])
        begin -= total[:-1]
        take = np.repeat(begin, size)
        take += np.arange(total[-1], dtype=np.int32)
        ids = self.cache.flat[take]
        return ids, total[np.searchsorted(at, firsts)].astype(np.int64)

    def _long(self, data: bytes) -> np.ndarray:
        """Ids of a text of any length, block by block."""
        out, low = [], 0
        while low < len(data):
            found = SAFE.search(data, min(low + BLOCK, len(data)))
            high = found.start() if found else len(data)
            out.append(self._block(np.frombuffer(data, dtype=np.uint8)[low:high], np.zeros(1, dtype=np.int64))[0])
            low = high
        return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)

    def column(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, ends) for runs of rows: ids has those of all texts of the run, ends where each text's end; 32-bit unsigned. Null
        and empty texts have none."""
        if texts.type != pa.string():
            texts = texts.cast(pa.string())
        if texts.null_count:
            texts = pc.fill_null(texts, "")
        n = len(texts)
        if not n:
            return
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.empty(0, dtype=np.uint8)
        whole = np.full(n, self.kinds is None)
        for token in self.added if self.kinds else []:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        alone = whole | (np.diff(offsets) > BLOCK)
        row = 0
        while row < n:
            if alone[row]:
                ids = self._whole(texts[row].as_py()) if whole[row] else self._long(data[offsets[row] : offsets[row + 1]].tobytes())
                yield row, ids, np.array([len(ids)])
                row += 1
                continue
            high = int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1
            others = np.flatnonzero(alone[row:high])
            high = max(row + int(others[0]) if len(others) else high, row + 1)
            ids, before = self._block(data[offsets[row] : offsets[high]], offsets[row : high + 1] - offsets[row])
            yield row, ids, before[1:]
            row = high

    def encode(self, text: str | None) -> bytes:
        """One text's ids as little-endian unsigned 32-bit bytes."""
        return b"".join(ids.astype("<u4").tobytes() for _, ids, _ in self.column(pa.array([text], pa.string())))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
