"""BPE encoding and decoding by a tokenization automaton.

The merge list is compiled, one merge gadget at a time, into a deterministic
automaton over *tokens* that accepts exactly one path for every word: the
sequence of tokens BPE produces.  It starts with one state that loops on every
base symbol.  The gadget of the k-th merge ``(a, b) -> c``

* copies the state that arcs labelled ``a`` lead to, drops the copy's arc
  ``b`` and points every ``a`` arc at the copy (``a`` can no longer be
  followed by ``b``: the pair would have been merged), and
* adds an arc ``c`` beside every arc ``a``, leading where ``b`` led.

Where an arc leads depends on its label only, so a state is named by the last
token read, and a copy differs from its original in one dropped arc.  The
compiled tables keep just these differences: ``cut`` (dropped arc -> gadget),
and per token its gadget and the two tokens joined there.  Whether state ``a``
still has an arc ``b`` follows from them by undoing gadgets from the last one
back, on the right of ``a`` and the left of ``b``, whichever is later: the arc is
gone if a pair that stood side by side in between was cut.

A prefix of an accepted path is the only path that spells its text, so every
place of a word has exactly one state.  A word is encoded by transitions from
place to place: the labels that end at a place come from a tree of the labels
read backwards, and the one whose arc exists from the state where it starts is
taken.  No step is taken back.  Many words are run through the tables at once, as
arrays.  Decoding walks the same arcs and emits their labels.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.steps import holds

#: Words of plain texts, and words split off by the file's own rules, that a
#: Python worker remembers in each of two generations.  They change the speed only.
CACHE_PLAIN, CACHE_SPELLED = 80_000, 20_000
#: Places for pairs of state and token whose arc has been looked up (a power of two).
KNOWN_ARCS = 1 << 18
#: Characters of text whose new words are run through the tables together.
GROUP_CHARS = 2_000_000
#: Fewer words than this are run one by one.
FEW = 16

#: Kinds of characters, and the contractions' letters.
_SPACE, _LETTER, _DIGIT, _SIGN, _BREAK = range(5)
_ONE, _TWO = [ord(c) for c in "stmd"], [ord(c) << 16 | ord(d) for c, d in ("re", "ve", "ll")]
_END = ""  # stands for the end-of-word suffix inside token strings
_SHIFT = 20


class _Table:
    """Numbers under non-negative integer keys, looked up array by array."""

    def __init__(self, entries: dict[int, int]):
        self.bits = max(4, (3 * len(entries)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        keys, values = np.fromiter(entries.keys(), np.int64, len(entries)), np.fromiter(entries.values(), np.int32, len(entries))
        at = self._first(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several keys for one place the last gets it
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers; -1 where there is none."""
        at = self._first(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        while len(left):
            at = (at if len(at) == len(left) else at[left]) + 1 & (len(self.keys) - 1)
            wanted, seen = keys[left], self.keys[at]
            hit = seen == wanted
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (seen != -1)
            left, at = left[on], at[on]
        return out


class MergeAutomaton:
    """The automaton of one merge list.  ``vocab`` maps token strings to ids,
    ``merges`` lists the merged pairs in order of their rank."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.text = {i: s for s, i in vocab.items()}
        n = max(vocab.values(), default=-1) + 1
        self.length, self.born, self.left, self.right = np.zeros(n, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.cut: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            self._gadget(rank, vocab[a], vocab[b], vocab[a + b])
        self._cut = _Table(self.cut)
        self._known = np.full(KNOWN_ARCS, -1, np.int64)  # pair and answer
        # labels read backwards: nodes, and the token that ends a path from the root
        self.codes = {c: k for k, c in enumerate(sorted({c for s in vocab for c in s}), 1)}
        self._chars = np.array([ord(c) for c in self.codes], np.uint32)
        width, child, ends = len(self.codes) + 1, {}, {}
        for s, i in vocab.items():
            self.length[i], node = len(s), 0
            for c in reversed(s):
                node = child.setdefault(node * width + self.codes[c], len(child) + 1)
            ends[node] = i
        self.width, self.child = width, child
        self.ends = np.full(len(child) + 1, -1, np.int32)
        self.ends[[*ends]] = [*ends.values()]
        self._child = _Table(child)
        # the first two steps, which are the most frequent, in one array
        self._two = np.full(width * width, -1, np.int32)
        self._one = np.array([child.get(k, -1) for k in range(width)], np.int32)
        for k in range(1, width):
            if self._one[k] >= 0:
                self._two[k * width:(k + 1) * width] = [child.get(int(self._one[k]) * width + j, -1) for j in range(width)]

    def _gadget(self, rank: int, a: int, b: int, c: int) -> None:
        self.cut.setdefault(a << _SHIFT | b, rank)
        if self.born[c] < 0:
            self.born[c], self.left[c], self.right[c] = rank, a, b

    def arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the state after each ``state`` has an arc ``token``.  At equal
        rank the pair further left is merged first, hence ``<`` and ``<=``."""
        out, at = np.ones(len(state), bool), np.arange(len(state))
        a, b = state.astype(np.int64), token.astype(np.int64)
        a_until = b_until = np.full(len(state), 1 << 30, np.int32)
        while len(at):
            rank = self._cut.get(a << _SHIFT | b)
            gone = (rank >= 0) & (rank < a_until) & (rank <= b_until)
            out[at[gone]] = False
            made_a, made_b = self.born[a], self.born[b]
            on = ~gone & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b, a_until, b_until = (x[on] for x in (at, a, b, made_a, made_b, a_until, b_until))
            undo = made_a >= made_b  # the later one of the two
            a_until, b_until = np.where(undo, made_a, a_until), np.where(undo, b_until, made_b)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return out

    def known_arcs(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """:meth:`arcs`, remembering each pair until another takes its place."""
        pairs = state.astype(np.int64) << _SHIFT | token
        at = (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) & KNOWN_ARCS - 1
        seen = self._known[at]
        out = (seen & 1).astype(bool)
        new = np.flatnonzero(seen >> 1 != pairs)
        if len(new):
            out[new] = self.arcs(state[new], token[new])
            self._known[at[new]] = pairs[new] << 1 | out[new]
        return out

    def arc(self, a: int, b: int) -> bool:
        """:meth:`arcs` of one pair."""
        a_until = b_until = 1 << 30
        while True:
            rank = self.cut.get(a << _SHIFT | b)
            if rank is not None and rank < a_until and rank <= b_until:
                return False
            made_a, made_b = int(self.born[a]), int(self.born[b])
            if made_a < 0 and made_b < 0:
                return True
            if made_a >= made_b:
                a_until, a = made_a, int(self.right[a])
            else:
                b_until, b = made_b, int(self.left[b])

    def encode(self, word: str) -> list[int]:
        """Token ids of ``word`` (already in the vocabulary's alphabet)."""
        n, child, width, ends = len(word), self.child, self.width, self.ends
        codes, last, known = [self.codes.get(c, 0) for c in word], [-1] * (len(word) + 1), {}
        for end in range(1, n + 1):
            node, at, labels = 0, end, []
            while at:
                node = child.get(node * width + codes[at - 1])
                if node is None:
                    break
                at -= 1
                if ends[node] >= 0:
                    labels.append((at, int(ends[node])))
            for at, token in reversed(labels):
                pair = last[at], token
                if at == 0 or pair[0] >= 0 and (known[pair] if pair in known else known.setdefault(pair, self.arc(*pair))):
                    last[end] = token
                    break
        path = []
        while n:
            if last[n] < 0:
                raise ValueError(f"no token spells {word[:40]!r}")
            path.append(last[n])
            n -= int(self.length[last[n]])
        return path[::-1]

    def encode_all(self, words: list[str]) -> list[bytes]:
        """Token ids of each word as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        for group in self._groups(words):
            if len(group) < FEW:
                for i in group:
                    out[i] = _pack(self.encode(words[i]))
                continue
            last, _, sizes = self._run([words[i] for i in group])
            # back along the states, all words a token at a time
            rows, ends, read = np.arange(len(group)), sizes.copy(), []
            while len(rows):
                tokens = last[rows, ends]
                read.append((rows, tokens))
                ends = ends - self.length[tokens]
                rows, ends = rows[ends > 0], ends[ends > 0]
            rows, steps = np.concatenate([r for r, _ in read]), np.repeat(np.arange(len(read)), [len(r) for r, _ in read])
            order = np.lexsort((-steps, rows))
            flat = np.concatenate([t for _, t in read])[order].astype("<u4").tobytes()
            cuts = 4 * np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(group)))])
            for i, x, y in zip(group, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[i] = flat[x:y]
        return out

    def count_all(self, words: list[str]) -> list[int]:
        """Numbers of tokens of each word: the automaton as a transducer, whose
        transitions add one to the count of the place they start from."""
        out = [0] * len(words)
        for group in self._groups(words):
            if len(group) < FEW:
                for i in group:
                    out[i] = len(self.encode(words[i]))
                continue
            _, counts, sizes = self._run([words[i] for i in group])
            for i, n in zip(group, counts[np.arange(len(group)), sizes].tolist()):
                out[i] = n
        return out

    @staticmethod
    def _groups(words: list[str]) -> list[list[int]]:
        """Words of similar lengths together, longest first in each group."""
        sizes = [*map(len, words)]
        order, out, first = sorted(range(len(words)), key=sizes.__getitem__, reverse=True), [], 0
        falling = -np.array(sizes, np.int64)[order]
        while first < len(order) and falling[first]:
            least = max(1, (-int(falling[first]) - 8) // 2)
            end = int(np.searchsorted(falling, -least, "right"))
            out.append(order[first:end])
            first = end
        return out

    def _run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For words by descending length: the last token and the number of tokens
        at each place of each word, and the words' lengths."""
        sizes = np.array([len(w) for w in words])
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        codes = np.searchsorted(self._chars, letters)
        codes = np.where(self._chars[np.minimum(codes, len(self._chars) - 1)] == letters, codes + 1, 0)
        symbols = np.zeros((len(words), int(sizes[0])), np.int64)
        symbols[np.arange(sizes[0]) < sizes[:, None]] = codes
        last, count = np.full((len(words), int(sizes[0]) + 1), -1, np.int32), np.zeros((len(words), int(sizes[0]) + 1), np.int32)
        for end in range(1, int(sizes[0]) + 1):
            n = int(np.searchsorted(-sizes, -end, "right"))  # words with a place so far on
            rows, at, labels = np.arange(n), end, []
            while at and len(rows):
                at -= 1
                if at == end - 1:
                    node = self._one[symbols[:n, at]]
                elif at == end - 2:
                    node = self._two[symbols[rows, at + 1] * self.width + symbols[rows, at]]
                else:
                    node = self._child.get(node.astype(np.int64) * self.width + symbols[rows, at])
                found = node >= 0
                rows, node = rows[found], node[found]
                token = self.ends[node]
                labels.append((at, rows[token >= 0], token[token >= 0]))
            free = np.ones(n, bool)
            for at, rows, token in reversed(labels):
                rows, token = rows[free[rows]], token[free[rows]]
                if at:
                    state = last[rows, at]
                    fits = state >= 0
                    fits[fits] = self.known_arcs(state[fits], token[fits])
                    rows, token = rows[fits], token[fits]
                last[rows, end], count[rows, end] = token, count[rows, at] + 1
                free[rows] = False
        if (last[np.arange(len(words)), sizes] < 0).any():
            raise ValueError("no token spells a character of these words")
        return last, count, sizes

    def decode(self, ids: list[int]) -> list[str]:
        """The labels of the arcs with these ids."""
        return list(map(self.text.__getitem__, ids))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable, else the next free one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class _Memory:
    """Remembers values in two generations; when the newer one is full it becomes
    the older, from which what is still in use is taken over."""

    def __init__(self, size: int):
        self.size, self.newer, self.older = size, {}, {}

    def missing(self, keys: set) -> set:
        """The keys that aren't remembered; the others are in ``newer`` now."""
        absent = keys - self.newer.keys()
        if len(self.newer) + len(absent) > self.size:
            self.newer, self.older, absent = {}, self.newer, keys
        back = absent & self.older.keys()
        self.newer.update(zip(back, map(self.older.__getitem__, back)))
        return absent - back


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class BpeCodec:
    """Encoder and decoder for a tokenizer file with a BPE model on bytes.

    Two kinds of pre-splitting occur in the files: lower-cased words without
    white space (files with an end-of-word suffix) and words that keep the
    space before them.  Texts of plain letters, digits and punctuation are
    split by a regular expression; texts with other characters go through the
    file's own normaliser and pre-tokenizer, for the same Unicode tables.
    """

    #: Characters on which the kinds below agree with any Unicode version.
    PLAIN = re.compile(r"[\t\n\r -~\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u02ff\u2010-\u2027\u2030-\u205e\u20ac]*\Z")
    #: Lower-casing leads plain characters nowhere beyond this code point.
    LAST = 0x2FFF

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.suffix = path, model.get("end_of_word_suffix") or ""
        self.lower = spec.get("normalizer") is not None
        mark = (lambda s: s.removesuffix(self.suffix) + _END if s.endswith(self.suffix) else s) if self.suffix else (lambda s: s)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = MergeAutomaton({mark(s): i for s, i in model["vocab"].items()}, [(mark(a), mark(b)) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: s for s, i in model["vocab"].items()} | {i: s for s, i in self.special.items()}
        self._special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._bytes = byte_alphabet()
        self._tail = _END if self.suffix else ""
        self._encoded, self._counted = ((_Memory(CACHE_PLAIN), _Memory(CACHE_SPELLED)) for _ in range(2))
        self._library = None
        every = "".join(map(chr, range(self.LAST + 1)))
        self._kinds = np.full(self.LAST + 1, _SIGN, np.uint8)
        for kind, pattern in ((_LETTER, r"[^\W\d_]"), (_DIGIT, r"\d"), (_SPACE, r"\s")):
            self._kinds[[m.start() for m in re.finditer(pattern, every)]] = kind
        self._kinds[0] = _BREAK

    def _spelled(self, word: str) -> str:
        """A word in the alphabet of the vocabulary."""
        if word.isascii() and word.isprintable():
            return word.replace(" ", self._bytes[32]) + self._tail
        table = self._bytes
        return "".join([table[b] for b in word.encode()]) + self._tail

    def _starts(self, letters: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Whether a word starts at each character of plain texts (code points and
        their kinds; the last two are breaks).

        A word is a run of one kind (a digit alone, where spaces are dropped), or
        one of the contractions 's 't 're 've 'm 'll 'd, which an apostrophe that
        starts a word begins.  Where spaces are kept, the last space before a run
        belongs to it, and other white space before the last is a word."""
        starts = np.ones(len(kind), bool)
        starts[1:] = kind[1:] != kind[:-1]
        if self.lower:
            starts |= kind == _DIGIT
            starts &= kind != _SPACE
        else:
            before = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _BREAK))
            starts[before] = True
            starts[before[letters[before] == 32] + 1] = False
        starts &= kind != _BREAK
        mark = np.flatnonzero((letters[:-2] == 39) & starts[:-2])
        mark = mark[kind[mark + 1] == _LETTER]
        one, two = letters[mark + 1], letters[mark + 1] << 16 | letters[mark + 2]
        size = np.where(np.isin(one, _ONE), 1, np.where(np.isin(two, _TWO), 2, 0))
        mark, size = mark[size > 0], size[size > 0]
        starts[mark + 1] = False
        after = mark + 1 + size
        starts[after[kind[after] == _LETTER]] = True
        return starts

    def _plain_words(self, parts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different words of plain texts, each word's number among them in
        the order of the texts, and how many words come before each text and at last."""
        text = "\0".join(parts) + "\0\0"
        letters = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self._kinds[letters]
        starts = np.flatnonzero(self._starts(letters, kind))
        kept = kind != _BREAK
        if self.lower:
            kept &= kind != _SPACE
        width = 1 + (letters > 0x7F).astype(np.int32) + (letters > 0x7FF)
        raw = np.frombuffer(text.encode(), np.uint8)
        raw = raw[kept if len(raw) == len(letters) else np.repeat(kept, width)]
        ends = np.cumsum(np.where(kept, width, 0))
        offsets = np.append(ends[starts] - width[starts], len(raw)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        first = np.cumsum([0, *(len(x) + 1 for x in parts)])
        return words.dictionary.to_pylist(), words.indices.to_numpy(), np.searchsorted(starts, first)

    def _split_any(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        if self._library.normalizer is not None:
            text = self._library.normalizer.normalize_str(text)
        return [w for w, _ in self._library.pre_tokenizer.pre_tokenize_str(text)]

    def _sections(self, text: str) -> list[tuple[str, int | None]]:
        """The text between special strings, and their ids."""
        if "<" not in text or self._special_re is None:
            return [(text, None)]
        return [(s, self.special.get(s) if i % 2 else None) for i, s in enumerate(self._special_re.split(text))]

    def _parse(self, text: str) -> list[tuple[str, object]]:
        """The text as ids of special strings, plain texts, and words that the
        file's own rules have split off and spelled."""
        out: list[tuple[str, object]] = []
        for part, special in self._sections(text):
            if special is not None:
                out.append(("special", special))
            elif self.PLAIN.match(part):
                out.append(("plain", part.lower() if self.lower else part))
            else:
                out.append(("spelled", self._split_any(part)))
        return out

    def _learnt(self, parsed: list[list[tuple[str, object]]], memory: tuple[_Memory, _Memory], run: Callable) -> tuple[list, np.ndarray, np.ndarray, dict]:
        """The results of the different words of all plain parts, each word's number
        and the parts' first words (see :meth:`_plain_words`), and the results of
        spelled words.  All words not remembered are run through the automaton together."""
        plain, spelled = memory
        words, numbers, first = self._plain_words([x for text in parsed for kind, x in text if kind == "plain"])
        new, other = [*plain.missing(set(words))], [*spelled.missing({w for text in parsed for kind, x in text if kind == "spelled" for w in x})]
        tail = self._tail
        results = run([*(w + tail if tail and w.isascii() else self._spelled(w) for w in new), *(w + tail for w in other)])
        plain.newer.update(zip(new, results))
        spelled.newer.update(zip(other, results[len(new):]))
        return [*map(plain.newer.__getitem__, words)], numbers, first, spelled.newer

    def _grouped(self, texts: Iterable[str]) -> Iterator[list[list[tuple[str, object]]]]:
        group, size = [], 0
        for t in texts:
            group.append(self._parse(t))
            size += len(t)
            if size > GROUP_CHARS:
                yield group
                group, size = [], 0
        yield group

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for parsed in self._grouped(texts):
            found, numbers, first, words = self._learnt(parsed, self._encoded, self.automaton.encode_all)
            # the words' ids one after the other, for all plain parts at once
            size = np.array([*map(len, found)], np.int64) // 4
            ids, start = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
            each = size[numbers]
            ends = np.cumsum(each)
            every = ids[np.arange(int(each.sum())) + np.repeat(start[numbers] - (ends - each), each)].tobytes()
            cuts = iter((4 * np.concatenate([[0], ends])[first]).tolist())
            at = next(cuts)
            for text in parsed:
                out: list[bytes] = []
                for kind, x in text:
                    if kind == "plain":
                        out.append(every[at:(at := next(cuts))])
                    elif kind == "spelled":
                        out.extend(map(words.__getitem__, x))
                    else:
                        out.append(x.to_bytes(4, "little"))
                yield b"".join(out)

    def count_all(self, texts: Iterable[str]) -> Iterator[int]:
        """Number of ids of each text, which are not made themselves."""
        for parsed in self._grouped(texts):
            found, numbers, first, words = self._learnt(parsed, self._counted, self.automaton.count_all)
            counts = iter(np.diff(np.concatenate([[0], np.cumsum(np.array(found, np.int64)[numbers])])[first]).tolist())
            yield from (sum(next(counts) if kind == "plain" else sum(map(words.__getitem__, x)) if kind == "spelled" else 1 for kind, x in text) for text in parsed)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(next(self.encode_all([text])), "<u4")

    def count(self, text: str) -> int:
        return next(self.count_all([text]))

    def decode(self, ids) -> str:
        """The arcs' labels: joined by spaces where the file has no decoder,
        else the bytes they stand for, read as UTF-8 (faulty bytes replaced)."""
        labels = map(self.labels.__getitem__, ids)
        if self.lower:
            return " ".join(labels)
        back = {c: b for b, c in enumerate(self._bytes)}
        special, out = {*self.special.values()}, bytearray()
        for i in ids:
            out += self.labels[i].encode() if i in special else bytes(back[c] for c in self.labels[i])
        return out.decode("utf-8", errors="replace")


_codec = lru_cache(maxsize=2)(BpeCodec)


def codec(path: str) -> BpeCodec:
    """One codec for each file and Python worker, until another operator's tasks
    run in the worker."""
    holds("bpe", _codec.cache_clear)
    return _codec(path)


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    for x in batch.column("text"):
        yield x.as_py() or ""


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every row of ``docs(doc_id, text)``; a null
    or empty text has no ids.  ``tokenizer`` is the file's path on all hosts."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            ids = pa.array([np.frombuffer(x, "<i4") for x in c.encode_all(_texts(b))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids], ["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, text`` of every row of ``encoded(doc_id, ids)``; null ids give
    the empty text."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            text = pa.array([c.decode(x.as_py() or []) for x in b.column("ids")], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), text], ["doc_id", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, in one
    pass: the text is encoded, its ids are decoded, and both are hashed where
    they are made, so neither leaves the task.

    Null text counts as empty; repeated rows are kept; no other column of
    ``docs`` is read."""

    def run(batches):
        c = codec(tokenizer)
        number = {i: str(i) for i in c.labels}
        for b in batches:
            n, ids_hash, text_hash = [], [], []
            for packed in c.encode_all(_texts(b)):
                ids = np.frombuffer(packed, "<u4").tolist()
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(" ".join(map(number.__getitem__, ids)).encode()).hexdigest())
                text_hash.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


__all__ = ["BpeCodec", "MergeAutomaton", "codec", "decode_documents", "encode_documents", "round_trip_digests"]
