"""Exact BPE encoding with a memo of whitespace-bounded pieces.

``PieceEncoder`` returns the ids that ``tokenizers.Tokenizer.encode(text, add_special_tokens=False)`` returns for the two
public vocabularies this package uses. Texts are cut only where the library's own pre-tokenizer is certain to cut
(next to single blanks), each distinct piece is encoded once per worker and kept in a bounded memo, and pieces that are
new are encoded together by a vectorised merge loop over the library's own merge table. Pieces with characters outside
plain Latin, with control strings or of unusual length are encoded by the library itself.

Texts of plain Latin letters, ASCII and simple blanks take the fast way: a batch of texts becomes one byte array, word
starts, word keys and memo look-ups are array operations, and no Python object is made per word.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task

_NONE = np.int32(2**31 - 1)
#: Characters whose classes, normal forms and lower case are the same in every Unicode version in use.
_PLAIN = re.compile("[!-~¡-¬®-įı-ž]+")
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_FAST = re.compile("[\n -~À-ÖØ-öø-įı-ž]*")
_ODD_BLANKS = re.compile(r"\s\s|\A\s|\s\Z|[^\S \n]")
_WORDS = re.compile(r" ?[^ \n]+|\n")
_LONGEST = 64
_SEGMENT = 1_000_000
_MEMO = 500_000


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class PairTable:
    """Ranks of id pairs: a few hash levels, each a direct-mapped array, so that a lookup is a handful of gathers."""

    def __init__(self, left: np.ndarray, right: np.ndarray, bits: int = 20):
        keys = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        ranks = np.arange(len(keys), dtype=np.int32)
        self.shift, self.levels = np.uint64(64 - bits), []
        odd = 0x9E3779B97F4A7C15
        while len(keys):
            factor = np.uint64(odd)
            slots = (keys * factor) >> self.shift
            _, first = np.unique(slots, return_index=True)
            held, value = np.full(1 << bits, np.uint64(2**64 - 1)), np.full(1 << bits, _NONE)
            held[slots[first]], value[slots[first]] = keys[first], ranks[first]
            self.levels.append((factor, held, value))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]
            odd, bits = (odd * 0xD1342543DE82EF95 + 2) % 2**64 | 1, max(8, bits)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) << np.uint64(16) | right.astype(np.uint64)
        keys[(left < 0) | (right < 0)] = np.uint64(2**64 - 2)
        return self._look(keys.ravel(), 0).reshape(keys.shape)

    def _look(self, keys: np.ndarray, level: int) -> np.ndarray:
        factor, held, value = self.levels[level]
        slots = (keys * factor) >> self.shift
        found = held[slots]
        same = found == keys
        out = np.where(same, value[slots], _NONE)
        if level + 1 < len(self.levels):  # only where another pair has the slot
            rest = np.flatnonzero(~same & (found != np.uint64(2**64 - 1)))
            if len(rest):
                out[rest] = self._look(keys[rest], level + 1)
        return out


class WordStore:
    """Memo from a word's bytes to its ids, held in arrays: two 64-bit keys of a word, and where its ids lie in a pool.

    Words of up to eight bytes are their own key; longer ones are told apart by 128 bits of two hashes.
    """

    def __init__(self, bits: int = 22):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        size = 1 << self.bits
        self.first, self.second = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.place = np.zeros(size, np.int64)
        self.pool, self.used, self.n = np.zeros(1 << 20, np.uint16), 0, 0

    def slots(self, first: np.ndarray) -> np.ndarray:
        return ((first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """place of each word's ids (start * 2^24 + count), or -1."""
        at, mask = self.slots(first), (1 << self.bits) - 1
        out = np.where((self.first[at] == first) & (self.second[at] == second), self.place[at], -1)
        todo = np.flatnonzero((out < 0) & (self.first[at] != 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & mask
            same = (self.first[at] == first[todo]) & (self.second[at] == second[todo])
            out[todo[same]] = self.place[at[same]]
            go = ~same & (self.first[at] != 0)
            todo, at = todo[go], at[go]
        return out

    def add(self, first: np.ndarray, second: np.ndarray, ids: list[bytes]) -> None:
        """Distinct words that are not held yet."""
        n = np.array([len(x) // 2 for x in ids], np.int64)
        flat, total = np.frombuffer(b"".join(ids), "<u2"), int(n.sum())
        while self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + total] = flat
        place = (self.used + n.cumsum() - n) << 24 | n
        self.used, self.n = self.used + total, self.n + len(ids)
        at, mask, todo = self.slots(first), (1 << self.bits) - 1, np.arange(len(ids))
        while len(todo):
            _, one = np.unique(at, return_index=True)
            free = one[self.first[at[one]] == 0]
            put = todo[free]
            self.first[at[free]], self.second[at[free]], self.place[at[free]] = first[put], second[put], place[put]
            rest = np.ones(len(todo), bool)
            rest[free] = False
            todo, at = todo[rest], (at[rest] + (self.first[at[rest]] != 0)) & mask


class PieceEncoder:
    """ids of whole texts; ``path`` is a vocabulary file of the tokenizers library (byte-level BPE, under 65,536 ids)."""

    def __init__(self, path: str, memo: int = _MEMO):
        import regex
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model, self.library = spec["model"], Tokenizer.from_file(path)
        vocab: dict[str, int] = model["vocab"]
        specials = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.ends = model.get("end_of_word_suffix") or ""
        self.by_word = bool(self.ends)
        self.tokens = [""] * (max(*vocab.values(), *specials.values()) + 1)
        for token, i in chain(vocab.items(), specials.items()):
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters], np.int32)
        self.final = np.array([vocab[x + self.ends] for x in letters], np.int32)
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        a, b = (np.array([vocab[x[k]] for x in merges], np.int64) for k in (0, 1))
        self.made = np.array([vocab[x + y] for x, y in merges], np.int32)
        self.ranks = PairTable(a, b)
        self.words = regex.compile(
            r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
            if self.by_word
            else r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.marks = [x[:2] for x in specials]
        self.pieces_memo: dict[str, bytes] = {}
        self.words_memo: dict[str, bytes] = {}
        self.most = memo
        self.store = WordStore()
        kind = np.full(256, 1, np.uint8)  # letters, and the bytes of letters outside ASCII
        kind[:128] = 3  # marks
        kind[[*range(65, 91), *range(97, 123)]] = 1
        kind[48:58], kind[[10, 32]], kind[0] = 2, 0, 9
        self.kind = kind

    # -- whole batches ------------------------------------------------------------------------------------------------
    def starts(self, b: np.ndarray) -> np.ndarray:
        """Where words start in the bytes of texts with a zero byte before, between and after them."""
        kind = self.kind[b]
        start = np.empty(len(b), bool)
        start[0] = False
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        if self.by_word:
            start |= kind == 2
            start &= (kind != 0) & (kind != 9)
        else:
            blank = kind == 0
            last = np.zeros(len(b), bool)  # of a run that a word follows: a blank goes to the word, a line end stands alone
            last[:-1] = blank[:-1] & ~blank[1:] & (kind[1:] != 9)
            start |= last
            taken = np.zeros(len(b), bool)
            taken[1:] = last[:-1] & (b[:-1] == 32)
            start &= ~taken & (kind != 9)
        if (quote := np.flatnonzero((b == 39) & start)).size:
            a, c = b[quote + 1], b[np.minimum(quote + 2, len(b) - 1)]
            one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
            two = ((a == 114) | (a == 118)) & (c == 101) | (a == 108) & (c == 108)
            for at, n in ((quote[one], 2), (quote[two & ~one], 3)):
                start[at + 1] = False
                nxt = at + n
                own = kind[nxt] != 9
                if self.by_word:
                    own &= kind[nxt] != 0
                start[nxt[own]] = True
        return start

    def _fast(self, texts: list[str]) -> list[bytes]:
        raw = b"\0".join(x.lower().encode() if self.by_word else x.encode() for x in texts)
        buf = b"\0" + raw + b"\0" * 40
        b = np.frombuffer(buf, np.uint8)[: len(raw) + 2]
        start = self.starts(b)
        edge = np.flatnonzero(b == 0)  # before and after each text
        at = np.flatnonzero(start)
        if self.by_word:
            stop = start | (self.kind[b] == 0)
            stop[edge] = True
            bounds = np.flatnonzero(stop)
            end = bounds[np.searchsorted(bounds, at) + 1] if len(at) else at
        else:
            end = np.append(at[1:], len(b) - 1)
            if len(at):
                inner = edge[1:-1]
                k = np.searchsorted(at, inner)  # the word before each inner edge ends there
                k, inner = k[k > 0], inner[k > 0]
                np.minimum.at(end, k - 1, inner)
        n = end - at
        words = np.ndarray(len(raw) + 2, "<u8", buf, strides=(1,))
        low = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
        first = words[at] & low[np.minimum(n, 8)]
        second = np.zeros_like(first)
        for k in range(8, 32, 8):
            more = np.flatnonzero(n > k)
            if not len(more):
                break
            w = words[at[more] + k] & low[np.minimum(n[more] - k, 8)]
            second[more] = (second[more] ^ w) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)
            second[more] ^= second[more] >> np.uint64(31)
            first[more] = (first[more] ^ (w * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0xFF51AFD7ED558CCD) ^ (first[more] >> np.uint64(32)) | np.uint64(1)
        for k in np.flatnonzero(n > 32).tolist():
            d = hashlib.blake2b(buf[at[k] : end[k]], digest_size=16).digest()
            first[k], second[k] = int.from_bytes(d[:8], "little") | 1, int.from_bytes(d[8:], "little")
        if self.store.n > 2_600_000:
            self.store.clear()
        place = self.store.find(first, second)
        if (new := np.flatnonzero(place < 0)).size:
            pairs = np.stack([first[new], second[new]], 1)
            _, one = np.unique(pairs.view("V16").ravel(), return_index=True)
            one = new[one]
            found = [buf[i:j] for i, j in zip(at[one].tolist(), end[one].tolist(), strict=True)]
            self.store.add(first[one], second[one], self._encoded(found))
            place[new] = self.store.find(first[new], second[new])
        count = place & 0xFFFFFF
        total = count.cumsum()
        out = self.store.pool[np.repeat((place >> 24) - (total - count), count) + np.arange(total[-1] if len(total) else 0)].tobytes()
        words_before = np.searchsorted(at, edge)
        marks = (2 * np.append(0, total)[words_before]).tolist()
        return [out[i:j] for i, j in zip(marks, marks[1:], strict=False)]

    def _encoded(self, found: list[bytes]) -> list[bytes]:
        """ids of each word, in the order given."""
        out: list[bytes] = [b""] * len(found)
        groups: dict[int, list[int]] = {}
        for i, raw in enumerate(found):
            groups.setdefault(min(-(-len(raw) // 8), _LONGEST // 8 + 1), []).append(i)
        for k, group in groups.items():
            if k > _LONGEST // 8:
                for i in group:
                    out[i] = self._long(found[i])
                continue
            for at in range(0, len(group), 50_000):
                part = group[at : at + 50_000]
                for i, ids in zip(part, self._merged([found[i] for i in part], 8 * k), strict=True):
                    out[i] = ids
        return out

    # -- pieces -----------------------------------------------------------------------------------------------------
    def segments(self, text: str):
        """The text in stretches of about a million characters, cut where any vocabulary cuts."""
        at = 0
        while len(text) - at > 2 * _SEGMENT:
            m = _SAFE.search(text, at + _SEGMENT)
            if not m:
                break
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def pieces(self, text: str) -> list[str]:
        if self.by_word:
            return text.replace("\n", " ").split(" ")
        return _SAFE.split(text) if _ODD_BLANKS.search(text) else _WORDS.findall(text)

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """uint16 ids of each text."""
        return [np.frombuffer(x, "<u2") for x in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian 16-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        ways: dict[bool, list[tuple[int, str]]] = {True: [], False: []}
        sizes = {True: 0, False: 0}

        def flush(fast: bool) -> None:
            parts = [x for _, x in ways[fast]]
            for (i, _), ids in zip(ways[fast], self._fast(parts) if fast else self._slow(parts), strict=True):
                out[i].append(ids)
            ways[fast], sizes[fast] = [], 0

        for i, text in enumerate(texts):
            if len(text) > 2 * _SEGMENT:
                for part in self.segments(text):
                    out[i] += (self._fast if self._is_plain(part) else self._slow)([part])
                continue
            fast = self._is_plain(text)
            ways[fast].append((i, text))
            sizes[fast] += len(text)
            if sizes[fast] > 3 * _SEGMENT:
                flush(fast)
        for fast in (True, False):
            if ways[fast]:
                flush(fast)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _is_plain(self, text: str) -> bool:
        return _FAST.fullmatch(text) is not None and not any(m in text for m in self.marks)

    def _slow(self, texts: list[str]) -> list[bytes]:
        cut = [self.pieces(x) for x in texts]
        self.learn(set(chain.from_iterable(cut)))
        return [b"".join(map(self.pieces_memo.__getitem__, x)) for x in cut]

    def learn(self, found: set[str]) -> None:
        """Encodes those that the memo lacks."""
        if len(self.pieces_memo) + len(found) > self.most:
            self.pieces_memo = {k: self.pieces_memo[k] for k in found if k in self.pieces_memo}
        missing = [x for x in found.difference(self.pieces_memo)]
        plain, other = [], []
        for x in missing:
            bare = x.lstrip(" \n")
            (plain if (not bare or _PLAIN.fullmatch(bare)) and not any(m in x for m in self.marks) else other).append(x)
        for x, e in zip(other, self.library.encode_batch_fast(other, add_special_tokens=False), strict=True):
            self.pieces_memo[x] = np.array(e.ids, "<u2").tobytes()
        find = self.words.findall
        if self.by_word:
            cut = [find(x.lower() if x.isascii() else unicodedata.normalize("NFC", x).lower()) for x in plain]
        else:
            cut = [find(x) for x in plain]
        self.merge(set(chain.from_iterable(cut)))
        get = self.words_memo.__getitem__
        self.pieces_memo.update((x, b"".join(map(get, ws))) for x, ws in zip(plain, cut, strict=True))

    # -- words ------------------------------------------------------------------------------------------------------
    def merge(self, found: set[str]) -> None:
        if len(self.words_memo) + len(found) > self.most:
            self.words_memo = {k: self.words_memo[k] for k in found if k in self.words_memo}
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for w in found.difference(self.words_memo):
            raw = w.encode()
            groups.setdefault(min(-(-len(raw) // 8), _LONGEST // 8 + 1), []).append((w, raw))
        for k, group in groups.items():
            if k > _LONGEST // 8:
                for w, raw in group:
                    self.words_memo[w] = self._long(raw)
            else:
                for at in range(0, len(group), 50_000):
                    part = group[at : at + 50_000]
                    for (w, _), ids in zip(part, self._merged([raw for _, raw in part], 8 * k), strict=True):
                        self.words_memo[w] = ids

    def _merged(self, raws: list[bytes], width: int) -> list[bytes]:
        n = np.array([len(x) for x in raws])
        letters = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in raws), np.uint8).reshape(-1, width)
        sym = self.inner[letters]
        rows = np.arange(len(raws))
        sym[rows, n - 1] = self.final[letters[rows, n - 1]]
        sym[np.arange(width)[None, :] >= n[:, None]] = -1
        sym = np.concatenate([sym, np.full((len(raws), 2), -1, np.int32)], 1)
        done = np.empty_like(sym)
        rank = np.full((len(raws), width + 1), _NONE)
        rank[:, :-1] = self.ranks(sym[:, :-2], sym[:, 1:-1])
        where, steps = rows, np.arange(width + 2)
        while len(where):
            at = rank.argmin(1)
            r = np.arange(len(where))
            best = rank[r, at]
            over = best == _NONE
            if over.any():
                done[where[over]] = sym[over]
                go = ~over
                where, sym, rank, at, best = where[go], sym[go], rank[go], at[go], best[go]
                r = np.arange(len(where))
                if not len(where):
                    break
            after = steps > at[:, None]
            np.copyto(sym[:, :-1], sym[:, 1:].copy(), where=after[:, :-1])
            sym[r, at] = self.made[best]
            np.copyto(rank[:, :-1], rank[:, 1:].copy(), where=after[:, :-2])
            rank[r, at] = self.ranks(sym[r, at], sym[r, at + 1])
            left = at > 0
            rank[r[left], at[left] - 1] = self.ranks(sym[r[left], at[left] - 1], sym[r[left], at[left]])
        kept = done >= 0
        flat, ends = done[kept].astype("<u2").tobytes(), (2 * kept.sum(1).cumsum()).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _long(self, raw: bytes) -> bytes:
        """One word of any length: a heap of adjacent pairs over a linked list."""
        import heapq

        sym = self.inner[np.frombuffer(raw, np.uint8)].tolist()
        sym[-1] = int(self.final[raw[-1]])
        n = len(sym)
        nxt, prv = [*range(1, n), -1], [-1, *range(n - 1)]
        first = self.ranks(np.array(sym[:-1]), np.array(sym[1:])).tolist()
        heap = [(r, i, sym[i], sym[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = nxt[i]
            r = int(self.ranks(np.array([sym[i]]), np.array([sym[j]]))[0]) if j >= 0 else int(_NONE)
            if r != _NONE:
                heapq.heappush(heap, (r, i, sym[i], sym[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.made[r]), -1
            nxt[i] = nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            nxt[j] = -1
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return np.array([x for x in sym if x >= 0], "<u2").tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode(ids, skip_special_tokens=False) gives for a vocabulary without a decoder."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """This worker's encoder of a vocabulary, made once."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
