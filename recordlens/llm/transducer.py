"""A byte-level BPE tokenizer compiled, as texts need it, into a deterministic transducer.

The state after a prefix of a text holds what can still matter: the kind of the
open pretoken, and for every suffix of it that some token begins with, the last
token before that suffix and how many tokens stand there. Prefixes that agree in
this have the same state, so words of any number share a bounded set of states.
A transition carries the change of the token count. New transitions are computed
by the tokenizers library and kept in a table; texts then run through the table
in parallel lanes, one chunk of a text per lane (see ``Transducer.run``).
"""

from __future__ import annotations

import bisect
import functools
import itertools
import json
import os
import pickle
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import xxhash

# What the word pattern of byte-level tokenizers takes as one piece after an apostrophe.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_BLANKS = frozenset("\t\n\x0b\x0c\r ")
_ODD_BLANKS = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_HIGH = re.compile("[\U00010000-\U0010ffff]")
_RARE = 0


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in names)
    names.update((b, chr(256 + i)) for i, b in enumerate(hidden))
    return [names[b] for b in range(256)]


@functools.cache
def _pieces(top: int) -> re.Pattern:
    """The library's word pattern with the classes of its characters spelled out, for texts of characters below ``top``.

    Classes of the plane that a text stays in are a table look-up; beyond it they are a search in ranges.
    """
    blank = "\\t\\n\\x0b\\x0c\\r "

    def chars(major):
        held = [c for c in range(top) if unicodedata.category(chr(c))[0] == major]
        cuts = [i for i in range(1, len(held)) if held[i] != held[i - 1] + 1]
        runs = zip([0, *cuts], [*cuts, len(held)])
        return "".join(f"\\U{held[a]:08x}-\\U{held[b - 1]:08x}" for a, b in runs)

    letter, digit = chars("L"), chars("N")
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


class Pieces(dict):
    """The number of each piece met lately, and the ids that the library's model gives for it.

    Pieces are kept in two generations of at most ``most``: when one is full it
    replaces the older one, and those that are met again come over.
    """

    def __init__(self, model, name: dict, most: int = 600_000, longest: int = 64):
        super().__init__()
        self.model, self.name, self.most, self.longest = model, name, most, longest
        self.older: tuple[dict, array, list] = ({}, array("I"), [0])
        self._empty()

    def kept(self) -> tuple[dict, array, list]:
        """Numbers, ids of all, and where those of each number begin."""
        return dict(self), self.ids, [0, *np.cumsum(self.sizes, dtype=np.int64).tolist()]

    def _bpe(self, piece: str) -> list[int]:
        plain = piece.isascii() and piece.isprintable()  # these bytes, but for the blank, are named by themselves
        named = piece.replace(" ", self.name[32]) if plain else piece.encode().decode("latin1").translate(self.name)
        return [t.id for t in self.model.tokenize(named)]

    def _empty(self) -> None:
        self.clear()
        self.ids, self.sizes = array("I"), array("q")

    def __missing__(self, piece: str) -> int:
        numbers, ids, lows = self.older
        at = numbers.get(piece)
        got = self._bpe(piece) if at is None else ids[lows[at] : lows[at + 1]]
        self.ids.extend(got)
        self.sizes.append(len(got))
        number = len(self.sizes) - 1
        if len(piece) <= self.longest:
            self[piece] = number
        return number

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.sizes) >= self.most:
            self.older = self.kept()
            self._empty()
        found = [_pieces(128 if t.isascii() else 0x110000 if _HIGH.search(t) else 0x10000).findall(t) for t in texts]
        numbers = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(found)), np.int64, sum(map(len, found)))
        size = np.array(self.sizes, np.int64)
        low = np.cumsum(size) - size
        n = size[numbers]
        ends = np.cumsum(n)
        ids = np.array(self.ids, "<u4")[np.repeat(low[numbers] - ends + n, n) + np.arange(n.sum())]
        cuts = np.concatenate([[0], ends])[np.cumsum([len(f) for f in found])[:-1]] if texts else []
        return np.split(ids, cuts) if texts else []


class _State:
    """``rep``: bytes of the open pretoken as first met; ``last``/``upto``: last token and count after each byte."""

    __slots__ = ("kind", "rep", "last", "upto", "lone", "blanks")


class Encoder:
    """Ids of whole texts by their pieces; has no states, so it is made soon and stays small."""

    def __init__(self, path: str, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec.get("pre_tokenizer") or {}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        names = _byte_names()
        vocab = self.library.get_vocab()
        self.compiled = (
            spec["model"]["type"] == "BPE"
            and not any(spec["model"].get(k) for k in ("dropout", "unk_token", "byte_fallback", "ignore_merges"))
            and not spec.get("normalizer")
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", []))
            and all(c in vocab for c in CONTRACTIONS)
            and all(names[ord(b)] in vocab for b in _BLANKS)
        )
        if self.compiled:
            self.name = str.maketrans({chr(b): n for b, n in enumerate(names)})
            self.pieces = Pieces(self.library.model, self.name, most)

    def snapshot(self) -> dict:
        return {"pieces": self.pieces.kept()}

    def restore(self, base: dict) -> None:
        """Starts from a ``snapshot`` of the same file."""
        self.pieces.older = base["pieces"]

    def plain(self, text: str) -> bool:
        """Whether the transducer covers the text: no special string, no unusual blank."""
        if any(s in text for s in self.special):
            return False
        return text.isascii() or not _ODD_BLANKS.search(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts: pieces by the word pattern, each new one encoded by the library's model and kept."""
        if not self.compiled:
            return [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        fits = [self.plain(t) for t in texts]
        got = iter(self.pieces.encode([t for t, f in zip(texts, fits) if f]))
        rest = [t for t, f in zip(texts, fits) if not f]
        other = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [next(got) if f else np.array(next(other).ids, "<u4") for f in fits]


class Transducer(Encoder):
    """The encoder with the states that count tokens."""

    def __init__(self, path: str, max_states: int = 200_000, max_symbols: int = 400):
        super().__init__(path)
        if not self.compiled:
            return
        vocab = self.library.get_vocab()
        names = _byte_names()
        back = {n: b for b, n in enumerate(names)}
        self.lone_id = {b: vocab[names[ord(b)]] for b in _BLANKS}
        size = 1 + max(vocab.values())
        self.lead, self.cont = np.zeros(size, np.int64), np.zeros(size, np.int8)
        self.length = np.zeros(size, np.int64)
        self.begins: set[bytes] = set()
        self.tokens: list[tuple[bytes, int]] = []
        for token, i in vocab.items():
            if token in self.special:
                continue
            raw = bytes(back[c] for c in token)
            inner = [0x80 <= b < 0xC0 for b in raw]
            self.lead[i] = inner.count(False)
            self.cont[i] = next((k for k, x in enumerate(inner) if not x), len(raw))
            self.length[i] = len(raw)
            self.begins.update(raw[:k] for k in range(1, len(raw)))
            self.tokens.append((raw, i))
        self.longest = max(map(len, self.begins))
        self.tokens.sort()
        self.raw = {i: raw for raw, i in self.tokens}
        self.follows: dict[tuple[int, bytes], bool] = {}
        self.max_states, self.max_symbols = max_states, max_symbols
        self.classes: dict[str, str] = {}
        self.base: dict | None = None
        self._reset()

    # ---- compilation

    def _reset(self) -> None:
        self.rare: dict[tuple[int, str], tuple[int, int]] = {}
        self.symbol = np.full(0x110000, _RARE, np.int16)
        self.chars = [""]
        self.columns = 64
        self.frozen = 0  # states that come from ``base``
        self.states: list[_State] = []
        self.known: dict[bytes, int] = {}
        if self.base is not None:
            self._load(self.base)
            return
        # next state << 8 | (change of the count + 64); -1: not known
        self.table = np.full((1024, self.columns), -1, np.int32)
        self.tops = np.full((1024, 5), -1, np.int32)
        self.flags = np.zeros((1024, 5), bool)
        start = _State()
        start.kind, start.rep, start.last, start.upto = "start", b"", (-1,), (0,)
        start.lone, start.blanks = False, 0
        self._number(start)

    def snapshot(self) -> dict:
        """All that was learned, as arrays; bounded by ``max_states``."""
        every = [self._state(i) for i in range(self.frozen + len(self.states))]
        kinds = sorted({s.kind for s in every})
        at = np.nonzero(self.table >= 0)
        digests = [b""] * len(every)
        for digest, number in self.known.items():
            digests[number] = digest
        return {
            "kinds": kinds, "kind": np.array([kinds.index(s.kind) for s in every], np.uint8),
            "rep": b"".join(s.rep for s in every), "size": np.array([len(s.rep) for s in every], np.int32),
            "last": np.concatenate([np.array(s.last, np.int32) for s in every]),
            "upto": np.concatenate([np.array(s.upto, np.int32) for s in every]),
            "lone": np.array([bool(s.lone) for s in every]), "blanks": np.array([s.blanks for s in every], np.int32),
            "digests": b"".join(digests), "chars": list(self.chars), "rows": at[0].astype(np.int32),
            "symbols": at[1].astype(np.int16), "steps": self.table[at],
            "tops": self.tops[: len(every)].copy(), "flags": self.flags[: len(every)].copy(),
            **super().snapshot(),
        }

    def restore(self, base: dict) -> None:
        """Starts from a ``snapshot`` of a transducer of the same file, also when the states are dropped."""
        super().restore(base)
        self.base = base
        self._reset()

    def _load(self, base: dict) -> None:
        n = self.frozen = len(base["size"])
        self.chars = list(base["chars"])
        while self.columns < len(self.chars):
            self.columns *= 2
        self.symbol[[ord(c) for c in self.chars[1:]]] = np.arange(1, len(self.chars))
        self.table = np.full((n + 1024, self.columns), -1, np.int32)
        self.table[base["rows"], base["symbols"]] = base["steps"]
        self.tops = np.full((n + 1024, 5), -1, np.int32)
        self.flags = np.zeros((n + 1024, 5), bool)
        self.tops[:n], self.flags[:n] = base["tops"], base["flags"]
        digests = base["digests"]
        self.known = {digests[16 * i : 16 * i + 16]: i for i in range(n)}
        self.places = np.concatenate([[0], np.cumsum(base["size"], dtype=np.int64)])

    def _state(self, number: int) -> _State:
        if number >= self.frozen:
            return self.states[number - self.frozen]
        base, s = self.base, _State()
        low, high = int(self.places[number]), int(self.places[number + 1])
        s.kind, s.rep = base["kinds"][base["kind"][number]], base["rep"][low:high]
        s.last = base["last"][low + number : high + number + 1].tolist()
        s.upto = base["upto"][low + number : high + number + 1].tolist()
        s.lone, s.blanks = bool(base["lone"][number]), int(base["blanks"][number])
        return s

    def _kind(self, c: str) -> str:
        got = self.classes.get(c)
        if got is None:
            major = unicodedata.category(c)[0]
            got = "blank" if c in _BLANKS else {"L": "letter", "N": "digit"}.get(major, "other")
            self.classes[c] = got
        return got

    def _bpe(self, raw: bytes) -> list[int]:
        return [t.id for t in self.library.model.tokenize(raw.decode("latin1").translate(self.name))]

    def _alive(self, before: int, begin: bytes) -> bool:
        """Whether a longer token that starts with ``begin`` can ever follow the token ``before``.

        Two tokens can stand side by side only if their bytes encode to just them. Where
        more than 24 tokens would have to be tried the answer is yes, which is always safe.
        """
        if before < 0:
            return True
        got = self.follows.get((before, begin))
        if got is None:
            lo = bisect.bisect_right(self.tokens, (begin, len(self.lead)))
            hi = bisect.bisect_left(self.tokens, (begin + b"\xff" * 4, -1))
            got = hi - lo > 24
            for raw, i in () if got else self.tokens[lo:hi]:
                if self._bpe(self.raw[before] + raw) == [before, i]:
                    got = True
                    break
            self.follows[before, begin] = got
        return got

    def _number(self, s: _State) -> int:
        """The number of the state that agrees with ``s`` in all that matters later."""
        n = len(s.rep)
        live = tuple(
            (n - j, s.last[j], s.upto[j] - s.upto[n])
            for j in range(max(0, n - self.longest), n)
            if (part := s.rep[j:]) in self.begins and self._alive(s.last[j], part)
        )
        tail = s.rep[n - live[0][0] :] if live else b""
        wide = 1
        while wide < 4 and wide <= n and 0x80 <= s.rep[n - wide] < 0xC0:
            wide += 1
        wide = min(wide, max(n, 1))
        tops = [s.last[n - k] if n - k > 0 else -1 for k in range(wide)]
        # a token that begins the pretoken, where a lone blank stands before it
        flags = [s.lone and t >= 0 and self.length[t] == n - k for k, t in enumerate(tops)]
        anchored = s.lone and any(m == n for m, _, _ in live)
        extra: tuple = ()
        if s.kind == "blank":
            extra = (s.rep[-1], s.blanks == 1, s.upto[n - 1] - s.upto[n])
        elif s.kind[:6] == "quote ":
            extra = (s.blanks,)
        key = xxhash.xxh3_128_digest(repr((s.kind, tail, live, tops, flags, anchored, extra)))
        got = self.known.get(key)
        if got is None:
            got = self.known[key] = self.frozen + len(self.states)
            s.last, s.upto = array("i", s.last), array("i", s.upto)
            self.states.append(s)
            if got >= len(self.table):
                more = max(1024, len(self.table) // 4)
                self.table = np.concatenate([self.table, np.full((more, self.columns), -1, np.int32)])
                self.tops = np.concatenate([self.tops, np.full((more, 5), -1, np.int32)])
                self.flags = np.concatenate([self.flags, np.zeros((more, 5), bool)])
            self.tops[got, :wide] = tops
            self.flags[got, :wide] = flags
            if s.kind == "blank":
                self.tops[got, 4] = self.lone_id[chr(s.rep[-1])]
        return got

    def _open(self, kind: str, before: bytes, count: int, c: str, lone: bool) -> _State:
        """A pretoken that has ``before`` (a space or nothing) and the character ``c``."""
        s = _State()
        s.kind, s.rep, s.last, s.upto = kind, b"", (-1,), (count,)
        s.lone, s.blanks = lone, 0
        self._extend(s, before)
        self._extend(s, c.encode())
        return s

    def _extend(self, s: _State, raw: bytes) -> None:
        base = s.upto[0]
        for b in raw:
            s.rep += bytes([b])
            ids = self._bpe(s.rep)
            s.last = (*s.last, ids[-1])
            s.upto = (*s.upto, base + len(ids))

    def _more(self, s: _State, kind: str, c: str) -> _State:
        """The open pretoken with one more character."""
        out = _State()
        out.kind, out.rep, out.last, out.upto = kind, s.rep, s.last, s.upto
        out.lone, out.blanks = s.lone, s.blanks
        self._extend(out, c.encode())
        return out

    def _step(self, number: int, c: str) -> tuple[int, int]:
        """State after one more character, and the change of the count."""
        s = self._state(number)
        kind, total = self._kind(c), s.upto[-1]
        if s.kind == "blank" and kind != "blank":
            spaced = s.rep[-1:] == b" "
            if s.blanks == 1:
                base, lone = (s.upto[0], s.lone) if spaced else (total, False)
            else:
                base, lone = (s.upto[-2], False) if spaced else (s.upto[-2] + 1, True)
            if not spaced and c == "'":
                kind = "quote"
            out = self._open(kind, b" " if spaced else b"", base, c, lone)
        elif s.kind == "quote" and c in "stmd":
            out = self._contraction(s, "done", c)
        elif s.kind in ("quote r", "quote v", "quote l") and c == {"r": "e", "v": "e", "l": "l"}[s.kind[-1]]:
            out = self._contraction(s, "done", s.kind[-1] + c)
        elif s.kind == "quote" and c in "rvl":
            out = self._open("quote " + c, b"", total, c, False)
            out.blanks = int(s.lone)  # for the contraction that may come
        elif s.kind == "quote" and kind == "other":
            out = self._more(s, "other", c)
        elif s.kind[:6] == "quote " and kind == "letter":
            out = self._more(s, "letter", c)
        elif s.kind == kind:
            out = self._more(s, kind, c)
            out.blanks = s.blanks + 1
        else:
            new = "quote" if c == "'" else kind
            out = self._open(new, b"", total, c, False)
            out.blanks = 1
        change = out.upto[-1] - total
        return self._number(out), change

    def _contraction(self, s: _State, kind: str, rest: str) -> _State:
        """The apostrophe's piece is one token; ``s`` is after the apostrophe or one letter further."""
        out = _State()
        # tokens before the apostrophe: one less than after it
        base = s.upto[0] if s.kind == "quote" else s.upto[0] - 1
        raw = ("'" + rest).encode()
        ids = self._bpe(raw)
        out.kind, out.rep = kind, raw
        out.last, out.upto = (-1, *[ids[-1]] * len(raw)), (base, *[base + 1] * len(raw))
        out.lone, out.blanks = s.lone if s.kind == "quote" else bool(s.blanks), 0
        return out

    def _miss(self, at: np.ndarray, codes: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and changes for lanes whose transition is not in the table."""
        to, change = np.empty(len(at), np.int32), np.empty(len(at), np.int32)
        fresh: dict[tuple[int, str], tuple[int, int]] = {}
        for i, (a, code, sym) in enumerate(zip(at.tolist(), codes.tolist(), symbols.tolist())):
            c = chr(code)
            got = fresh.get((a, c)) or self.rare.get((a, c))
            if got is None:
                got = fresh[a, c] = self._step(a, c)
                if sym == _RARE or not -64 <= got[1] < 192:
                    self.rare[a, c] = got
                else:
                    self.table[a, sym] = got[0] << 8 | got[1] + 64
            to[i], change[i] = got
        return to, change

    def _learn_symbols(self, codes: np.ndarray) -> None:
        seen = np.flatnonzero(np.bincount(codes[self.symbol[codes] == _RARE], minlength=1))
        for code in seen.tolist():
            if len(self.chars) >= self.max_symbols:
                return
            if len(self.chars) == self.columns:
                self.table = np.hstack([self.table, np.full_like(self.table, -1)])
                self.columns *= 2
            self.symbol[code] = len(self.chars)
            self.chars.append(chr(code))

    # ---- running

    def _lanes(self, codes, symbols, lows, highs, entry, trace):
        """Runs ``codes[lows[i]:highs[i]]`` from ``entry[i]``, all lanes side by side.

        Returns exit states and count changes; ``trace`` (if given) gets the state
        after every character.
        """
        order = np.argsort(lows - highs, kind="stable")
        at, state = lows[order], entry[order].astype(np.int32)
        sizes = (highs - lows)[order]
        change = np.zeros(len(order), np.int64)
        active = len(order)
        most = int(sizes[0]) if active else 0
        ends = np.searchsorted(-sizes, -np.arange(most), side="left")  # lanes longer than j
        for j in range(most):
            active = int(ends[j])
            where = at[:active] + j
            sym, now = symbols[where], state[:active]
            flat = now.astype(np.int64) * self.columns + sym
            got = self.table.reshape(-1)[flat]
            to, add = got >> 8, (got & 255) - 64
            bad = np.flatnonzero(got < 0)
            if len(bad):
                to[bad], add[bad] = self._miss(now[bad], codes[where[bad]], sym[bad])
            state[:active] = to
            change[:active] += add
            if trace is not None:
                trace[where] = to
        out_state, out_change = np.empty_like(state), np.empty_like(change)
        out_state[order], out_change[order] = state, change
        return out_state, out_change

    def run(self, texts: list[str], chunk: int = 192, traced: bool = False):
        """Token counts of texts, and with ``traced`` the state after every character.

        A chunk is mapped from the state it is entered with to the state it is left
        with and its count. Where a chunk has a blank after a visible character, the
        part from there on does not depend on the entry: its map is constant and is
        run for all chunks at once. The heads before that follow by a scan over the
        chunks: all heads whose entry is known run at once, so only chunks without
        such a place wait for the one before.
        """
        if self.frozen + len(self.states) > self.max_states:
            self._reset()
        raw = "".join(texts).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(raw, "<u4").astype(np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        first = np.cumsum(lengths) - lengths
        counts = np.zeros(len(texts), np.int64)
        trace = np.zeros(len(codes), np.int32) if traced else None
        if not len(codes):
            return counts, codes, trace
        self._learn_symbols(codes)
        symbols = self.symbol[codes]
        blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
        sync = blank.copy()
        sync[1:] &= ~blank[:-1]
        sync[first[lengths > 0]] = True
        pieces = -(-lengths // chunk)
        owner = np.repeat(np.arange(len(texts)), pieces)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lows = first[owner] + step * chunk
        highs = np.minimum(lows + chunk, (first + lengths)[owner])
        places = np.flatnonzero(sync)
        place = np.append(places, len(codes))[np.searchsorted(places, lows)]
        fixed = place < highs
        place = np.minimum(place, highs)
        out = np.full(len(owner), -1, np.int32)
        change = np.zeros(len(owner), np.int64)
        k = np.flatnonzero(fixed)
        out[k], change[k] = self._lanes(codes, symbols, place[k], highs[k], np.zeros(len(k), np.int32), trace)
        waiting = np.flatnonzero(place > lows)
        while len(waiting):
            known = out[waiting - 1] >= 0
            ready, waiting = waiting[known], waiting[~known]
            left, add = self._lanes(codes, symbols, lows[ready], place[ready], out[ready - 1], trace)
            change[ready] += add
            whole = ~fixed[ready]
            out[ready[whole]] = left[whole]
        np.add.at(counts, owner, change)
        return counts, codes, trace

    def counts(self, texts: list[str]) -> list[int]:
        if not self.compiled:
            return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        fits = [self.plain(t) for t in texts]
        got = iter(self.run([t for t, f in zip(texts, fits) if f])[0].tolist())
        rest = [t for t, f in zip(texts, fits) if not f]
        other = (len(e) for e in self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [next(got if f else other) for f in fits]


_MADE: dict[str, Encoder] = {}
# states of a sample and of a worker that begins with it; such workers stand beside those of other stages
SAMPLE_STATES, SHARED_STATES = 60_000, 80_000
SHARED_PIECES = 100_000


def learned(docs, tokenizer: str, text_col: str = "text", counting: bool = True, rows: int = 1500, size: int = 4_000_000):
    """What a transducer learns from a bounded sample of texts, as a broadcast for all workers; None if it cannot.

    Each worker would compute the same common transitions anew (without ``counting``, ids of common pieces only). The sample (``rows`` texts,
    ``size`` characters at most, of the first partition that has any) only saves that work: what
    it lacks is computed where it is met, and results do not depend on it. One task learns; the
    driver passes on the bytes of what it learned, which are bounded by the states.
    """
    from pyspark.sql import functions as F

    if not tokenizer.endswith(".json"):
        return None

    def learn(batches):
        machine, count, total = None, 0, 0
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t] if count < rows and total < size else []
            if not texts:
                continue
            if machine is None:
                machine = Transducer(tokenizer, max_states=SAMPLE_STATES) if counting else Encoder(tokenizer, SHARED_PIECES)
            if not machine.compiled:
                break
            texts = [t for t in texts[: rows - count] if machine.plain(t)]
            for at in range(0, len(texts), 256):
                if counting and len(machine.states) > machine.max_states - 10_000 or total >= size:
                    break
                part = texts[at : at + 256]
                if counting:
                    machine.run(part)
                machine.pieces.encode(part)
                count, total = count + len(part), total + sum(map(len, part))
        if machine is not None:
            found = pickle.dumps(machine.snapshot()) if machine.compiled else None
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], names=["snapshot"])

    sample = docs.select(F.left(F.col(text_col), F.lit(20_000)).alias("text"))
    found = sample.mapInArrow(learn, "snapshot binary").first()
    if found is None or found[0] is None:
        return None
    return docs.sparkSession.sparkContext.broadcast(bytes(found[0]))


def transducer(path: str, start=None, counting: bool = True) -> Encoder:
    """One transducer for each Python worker, from what was ``learned`` if that is given; ids need no ``counting``."""
    made = _MADE.get(path)
    if made is None or counting and not isinstance(made, Transducer):
        if counting:
            made = Transducer(path) if start is None else Transducer(path, max_states=SHARED_STATES)
        else:
            made = Encoder(path) if start is None else Encoder(path, SHARED_PIECES)
        if start is not None and made.compiled:
            made.restore(pickle.loads(start.value))
        _MADE[path] = made
    return made


def forget(path: str) -> None:
    """Gives the memory of a worker's transducer back."""
    _MADE.pop(path, None)


def in_blocks(batches, rows: int = 512, chars: int = 1_000_000):
    """``(id, text)`` pairs of Arrow batches in lists of bounded size; null texts are empty."""
    block, size = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):  # a whole batch as Python texts would stand beside the table
            part = batch.slice(at, rows)
            for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                block.append((i, text or ""))
                size += len(block[-1][1])
                if len(block) >= rows or size >= chars:
                    yield block
                    block, size = [], 0
    if block:
        yield block
