"""Byte-level BPE inside tasks: a vocabulary from a tokenizer file, ids of
whole texts, and exact token counts of every prefix by dynamic programming.

Texts are cut at single spaces between other characters. Such a cut is always
a boundary of the pre-tokenizer too (the space opens the next piece), so the
parts tokenize independently and a bounded memo of parts does most of the
work; only parts next to other white space are taken together."""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import public_tokenizers
import regex

from .ragged import KeyTable, mix

#: Fixed: the pre-tokenizer's pattern is published with the vocabulary.
PATTERN = regex.compile(public_tokenizers.PATTERN)

#: The same cut, with each piece taken together with the white space before it.
_UNIT = regex.compile(r"\p{White_Space}*(?:(?<! )(?:'s|'t|'re|'ve|'m|'ll|'d)|\p{L}+|\p{N}+|[^\p{White_Space}\p{L}\p{N}]+)|\p{White_Space}+")
_UNIT_PARTS = regex.compile(r"(\p{White_Space}*)(.*)", regex.DOTALL)
#: White space other than the space, also a few controls that only Python counts as such.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 0x20]
_OTHER_SPACE_ASCII = [c for c in _OTHER_SPACE if c.isascii()]


#: Pieces up to this length keep the states of their prefixes for other pieces.
_SHARED_BYTES = 24

#: Parts of words of letters of at most two bytes: perhaps a space first, lines between, each word with at most one run
#: of ASCII marks (but quotes, which open contractions) behind it. Runs of marks and line ends are pieces of their own.
_LETTERS, _MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", r"[!-&(-/:-@\[-`{-~]+"
_WORDS = re.compile(f" ?{_LETTERS}(?:{_MARKS})?(?:\n{_LETTERS}(?:{_MARKS})?)*")
_PIECES = re.compile(f"( ?{_LETTERS})|({_MARKS})|\n")
#: A change of the count by one, as it is stored.
_ONE = struct.pack("<h", 1)


class Memo(dict):
    """A memo in two generations of at most ``size`` entries each: entries in
    use move to the young one, the old one is dropped whole."""

    def __init__(self, make, size: int = 200_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and special strings of a byte-level BPE file (.json)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        byte = _byte_alphabet()
        raw = lambda s: bytes(byte[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.ids = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.longest = max(map(len, self.ids))
        size = 1 + max(self.ids.values())
        self.rank, self.joined = [-1] * size, {}
        self.left, self.right = list(range(size)), list(range(size))  # a byte is its own half
        for r, m in enumerate(model["merges"]):
            a, b = map(raw, m.split(" ") if isinstance(m, str) else m)
            t = self.ids[a + b]
            self.joined[self.ids[a], self.ids[b]] = t
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = r, self.ids[a], self.ids[b]
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._follows_memo = Memo(self._adjacent, 300_000)
        self._units = Memo(self.unit_steps, 100_000)
        self._states = Memo(self._prefix_state, 200_000)
        # tokens that the merge rules do produce from their own bytes
        self.reachable = {t: i for t, i in self.ids.items() if len(t) == 1 or self._adjacent((self.left[i], self.right[i]), i)}

    def _adjacent(self, pair: tuple[int, int], unless: int = -1) -> bool:
        """Whether two tokens can stand side by side: no merge across their
        border comes due before the merges that made them. Undoes the later
        merge of the two again and again and looks at what meets at the
        border; ``unless`` is a token that may span it at the end."""
        a, b = pair
        rank, left, right, joined = self.rank, self.left, self.right, self.joined
        due = 1 << 60  # ranks from here on are not reached while these two meet
        if unless >= 0:
            due = rank[unless]
        while True:
            t = joined.get((a, b))
            if t is not None and rank[t] < due:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                due, a = ra, right[a]  # equal ranks to the left come first
            else:
                due, b = rb + 1, left[b]

    def _prefix_state(self, prefix: bytes) -> tuple[int, int]:
        """(last token, token count) of a piece's prefix, from shorter ones."""
        known, follows, state = self.reachable.get, self._follows_memo, self._states
        for j in range(len(prefix)):
            t = known(prefix[j:])
            if t is not None:
                if j == 0:
                    return t, 1
                last, count = state[prefix[:j]]
                if follows[last, t]:
                    return t, count + 1
        raise AssertionError("a single byte is a token")

    def piece_counts(self, piece: bytes) -> list[int]:
        """Token count of every byte prefix of one piece. The tokens of a
        prefix end in the one vocabulary token t that fits both the bytes and
        the last token of what stands before t; so count[i] = count[i - |t|] + 1."""
        n = len(piece)
        if n <= _SHARED_BYTES:  # words share prefixes, and with them their counts
            state = self._states
            return [0] + [state[piece[:i]][1] for i in range(1, n + 1)]
        last = [0] * (n + 1)
        count = [0] * (n + 1)
        known, longest, follows = self.reachable.get, self.longest, self._follows_memo
        for i in range(1, n + 1):
            for j in range(i - longest if i > longest else 0, i):
                t = known(piece[j:i])
                if t is not None and (j == 0 or follows[last[j], t]):
                    last[i], count[i] = t, count[j] + 1
                    break
        return count

    def _char_counts(self, piece: str) -> list[int]:
        """Token count of every code point prefix of one piece (its own length + 1 values)."""
        raw = piece.encode()
        count = self.piece_counts(raw)
        if len(raw) == len(piece):
            return count
        at, out = 0, [0]
        for c in piece:
            at += len(c.encode())
            out.append(count[at])
        return out

    def unit_counts(self, unit: str) -> list[int]:
        """Counts of the prefixes 1, 2, ... of white space plus one piece.

        A prefix that ends within the white space takes all of it as one
        piece; once the piece has begun, the last white space character joins
        it (a space) or stands alone, and the others are one piece."""
        if unit[0] == " " and len(unit) > 1 and not unit[1].isspace():
            return self._char_counts(unit)[1:]
        space, body = _UNIT_PARTS.fullmatch(unit).groups()
        out = self._char_counts(space)[1:]
        if not body:
            return out
        base = 0
        if space:
            base = self._char_counts(space[:-1])[-1]
            if space[-1] == " ":
                return out + [base + c for c in self._char_counts(" " + body)[2:]]
            base += self._char_counts(space[-1])[-1]
        if not space.endswith(" ") and body[0] == "'" and PATTERN.fullmatch(body) and len(body) > 1 and body[1].isalpha():
            # a contraction is whole only at its end; before that, a quote and letters
            inner = [1] + [1 + c for c in self._char_counts(body[1:])[1:]]
            inner[-1] = self._char_counts(body)[-1]
            return out + [base + c for c in inner]
        return out + [base + c for c in self._char_counts(body)[1:]]

    def part_steps(self, part: str) -> bytes:
        """Changes of the count from each prefix of ``part`` to the next, as
        little-endian int16, one for each code point."""
        return b"".join(map(self._units.__getitem__, _UNIT.findall(part)))

    def unit_steps(self, unit: str) -> bytes:
        counts = self.unit_counts(unit)
        return struct.pack(f"<{len(counts)}h", counts[0], *map(int.__sub__, counts[1:], counts))


class WordCounts:
    """Token counts of every prefix of many words at once: the dynamic
    programming of ``Vocabulary.piece_counts`` over arrays. At position i the
    words still open try the start of their last token from the farthest on."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.tokens: dict[int, tuple] = {}
        self.may_end = np.zeros((_SHARED_BYTES + 1, 1 << 16), bool)  # by length and the last four bytes' hash
        by_length: dict[int, list[bytes]] = {}
        for t in vocabulary.reachable:
            if len(t) <= _SHARED_BYTES:
                by_length.setdefault(len(t), []).append(t)
        for n, ts in by_length.items():
            packed = np.frombuffer(b"".join(t.ljust(_SHARED_BYTES, b"\0") for t in ts), "<u8").reshape(-1, 3)
            ids = np.asarray([vocabulary.reachable[t] for t in ts], np.int64)
            self.tokens[n] = KeyTable(self._keys(n, packed.T)), packed, ids
            ends = np.frombuffer(b"".join(t[-4:].rjust(4, b"\0") for t in ts), "<u4")
            self.may_end[n, self._end(ends) if n >= 4 else slice(None)] = True
        self.pairs = Memo(lambda k: vocabulary._adjacent((k >> 32, k & 0xFFFFFFFF)), 400_000)

    @staticmethod
    def _keys(n: int, words) -> np.ndarray:
        """Keys of byte strings of one length as up to three integers; up to eight bytes are their own key."""
        key = words[0]
        for w in words[1:(n + 7) // 8]:
            key = mix(mix(key) + w)
        return key

    @staticmethod
    def _end(last_four: np.ndarray) -> np.ndarray:
        return (last_four.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(16)) & np.uint64(0xFFFF)

    def _find(self, n: int, words: list[np.ndarray]) -> np.ndarray:
        """Token numbers of byte strings of length n, -1 where there is none."""
        if n not in self.tokens:
            return np.full(len(words[0]), -1, np.int64)
        table, packed, ids = self.tokens[n]
        row = table.rows(self._keys(n, words))
        found = row >= 0
        if n > 8:  # the key is a hash: compare the bytes
            for w, own in zip(words, packed.T, strict=False):
                found &= own[row] == w
        return np.where(found, ids[row], -1)

    def _follow(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        pairs, at = np.unique(last << 32 | token, return_inverse=True)
        return np.asarray(list(map(self.pairs.__getitem__, pairs.tolist())), bool)[at]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """A row for each word of at most 24 bytes: its count at every prefix length from 0 on."""
        if not words:
            return np.zeros((0, _SHARED_BYTES + 1), np.int16)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        wide = _SHARED_BYTES + 8
        flat = np.frombuffer(b"".join(words[k].ljust(wide, b"\0") for k in order), np.uint8)
        at_byte = np.ndarray(len(flat) - 7, "<u8", flat.data, strides=(1,))
        count = np.zeros((len(words), _SHARED_BYTES + 1), np.int16)
        last = np.full((len(words), _SHARED_BYTES + 1), -1, np.int64)
        for i in range(1, int(size.max(initial=0)) + 1):
            todo = np.arange(int((size >= i).sum()))
            ends = self._end(at_byte[todo * wide + i - 4] & np.uint64(0xFFFFFFFF)) if i >= 4 else None
            for j in range(i):
                n = i - j
                row = todo[self.may_end[n, ends[todo]]] if n >= 4 else todo
                if not len(row):
                    continue
                token = self._find(n, [at_byte[row * wide + (j + k)] & np.uint64((1 << 8 * min(8, n - k)) - 1) for k in range(0, n, 8)])
                hit = token >= 0
                row, token = row[hit], token[hit]
                if j and len(row):
                    fits = self._follow(last[row, j], token)
                    row, token = row[fits], token[fits]
                if len(row):
                    last[row, i], count[row, i] = token, count[row, j] + 1
                    todo = todo[last[todo, i] < 0]
                    if not len(todo):
                        break
        out = np.empty_like(count)
        out[order] = count
        return out


def parts_of(text: str) -> list[str]:
    """``text`` cut before single spaces between other characters; the parts
    after the first keep their space."""
    pieces = text.split(" ")
    others = _OTHER_SPACE_ASCII if text.isascii() else _OTHER_SPACE
    if not ("" in pieces or any(c in text and (c + " " in text or " " + c in text) for c in others)):
        return pieces[:1] + [" " + p for p in pieces[1:]]
    out = [pieces[0]]
    for p in pieces[1:]:
        if not p or p[0].isspace() or not out[-1] or out[-1][-1].isspace():
            out[-1] += " " + p  # the space stands next to other white space
        else:
            out.append(" " + p)
    return out


class PrefixCounter:
    """Per-task state: steps of whole texts through the part memo."""

    def __init__(self, vocabulary: Vocabulary, memo_size: int = 400_000):
        self.v = vocabulary
        self.words = WordCounts(vocabulary)
        self.memo = Memo(vocabulary.part_steps, memo_size)

    def learn(self, parts: set[str]) -> None:
        """Put the words among parts not met before into the memo, all in one go."""
        memo, old, marks = self.memo, self.memo.old, self.v._units
        new = [p for p in parts if p not in memo and p not in old and _WORDS.fullmatch(p)]
        words = {w for p in new for w, _ in _PIECES.findall(p) if w}
        raws = {w: w.encode() for w in words if w not in memo and w not in old and len(w) <= _SHARED_BYTES}
        raws = {w: r for w, r in raws.items() if len(r) <= _SHARED_BYTES}
        steps = np.diff(self.words.counts(list(raws.values())), axis=1).astype("<i2") if raws else ()
        for own, (word, raw) in zip(steps, raws.items(), strict=True):
            if len(raw) == len(word):
                memo.put(word, own[:len(word)].tobytes())
            else:  # the bytes of a letter are one step
                first = [0, *accumulate(len(c.encode()) for c in word[:-1])]
                memo.put(word, np.add.reduceat(own[:len(raw)], first).astype("<i2").tobytes())
        for p in new:
            if p not in words:
                memo.put(p, b"".join([memo[w] if w else marks[m] if m else _ONE for w, m in _PIECES.findall(p)]))

    def all_steps(self, texts: list[str]) -> Iterator[np.ndarray]:
        """``steps`` of each text; takes a few megabytes of texts at a time."""
        special = self.v.special if self.v.special_split is not None else ()
        parts = [parts_of(t) if t and not any(s in t for s in special) else None for t in texts]
        self.learn(set().union(*(p for p in parts if p)))
        for t, p in zip(texts, parts, strict=True):
            yield self.steps(t) if p is None else np.frombuffer(b"".join(map(self.memo.__getitem__, p)), "<i2")

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, parts_of(text))) if text else b""

    def steps(self, text: str) -> np.ndarray:
        """Change of the exact token count at each code point of ``text``; a
        special string counts as one token once it is complete."""
        if self.v.special_split is None or not any(s in text for s in self.v.special):
            return np.frombuffer(self._plain(text), "<i2")
        pieces, out = self.v.special_split.split(text), []
        for k in range(0, len(pieces), 2):
            plain = pieces[k]
            if k + 1 == len(pieces):
                out.append(np.frombuffer(self._plain(plain), "<i2"))
                break
            # until its last character a special string is ordinary text
            s = np.frombuffer(self._plain(plain + pieces[k + 1][:-1]), "<i2").astype(np.int64)
            at_plain, at_end = int(s[:len(plain)].sum()), int(s.sum())
            out += [s, np.asarray([at_plain + 1 - at_end])]
        return np.concatenate(out).astype("<i2")


def counts_at(steps: bytes) -> np.ndarray:
    """Token count of every prefix, from the stored steps."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, "<i2"), dtype=np.int64)])


def longest_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts_at(steps) <= budget)[-1]) if budget >= 0 else 0
