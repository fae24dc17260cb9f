"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding. A prefix of a piece has one encoding, and a sequence of tokens is the encoding of its
bytes exactly if every adjacent pair is the encoding of its own bytes. The nondeterministic machine
therefore holds, after each byte, the positions at which a token that is still being read may have
begun, each with its path in the vocabulary's prefix tree and with the tokens that lead to it. Its
sets of positions are the states of the transducer. A move is determinised, and kept in a bounded
memory, when it is met for the ``VISITS``th time. Before that, the piece runs through the nondeterministic
machine depth first, longest token first, since most moves of rare words are never met again; of the
positions it tries, one that led nowhere is not tried again. The pieces of a block of texts that do so
run in step, as arrays (``Together``). The deterministic machine emits a token as
soon as all positions agree on it, a bounded lookahead behind the byte just read.

Decoding. Bytes of the tokens run through an incremental UTF-8 state machine, whose state is an
unfinished character of at most three bytes. Its moves over whole tokens are kept as well.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyalspan.llm.ship import held, ship

MOVES_KEPT = 250_000
VISITS = 4  # a move is determinised when it is met so often
HEAD = 4  # bytes of a token that are looked up at once
WORDS_KEPT = 200_000
MARKS = ",.;:!?"
OTHER_LETTERS = "\u0250"  # letters below are told alike by all versions of Unicode
ROWS = 64
BLOCK = 1 << 20  # bytes of text that are encoded together, or one row
FEW = 48  # so few pieces are run one by one
LONG = 4096  # bytes of a piece that is run alone
SLOTS = 1 << 20  # pairs kept beside each other
UNKNOWN = -2
NEVER = 1 << 62
# White space other than the six ASCII ones. By it, texts cannot be cut at blanks.
OTHER_SPACES = (
    "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A blank beside other ASCII white space is no cut either: one match may hold both.
BLANK_BESIDE = regex.compile(r" [\x20\x09-\x0D]|[\x09-\x0D] ")


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


MET = tuple((times,) for times in range(VISITS))  # moves that were met so often


class State(dict):
    """A state of the transducer: byte to (next state, tokens emitted), or how often it was met."""

    __slots__ = ("content",)


class Transducer:
    """Encodes one piece of text, given as bytes, by the ranks of its tokens."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.tree: dict[int, int] = {}  # node and byte to node
        self.token_at = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                following = self.tree.get(node << 8 | byte)
                if following is None:
                    following = len(self.token_at)
                    self.tree[node << 8 | byte] = following
                    self.token_at.append(-1)
                node = following
            self.token_at[node] = rank
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.shorter = {rank: self._longest_inside(token) for token, rank in ranks.items()}
        self.heads: dict[bytes, tuple[int, int]] = {}
        # Per node twice its token (-1: none), plus one if longer tokens begin like it.
        inner = {node >> 8 for node in self.tree}
        self.facts = [2 * token + (node in inner) for node, token in enumerate(self.token_at)]
        self.pairs: dict[int, bool] = {}
        self.splits: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.regular = True
        self.together: Together | None = None
        self.states: dict[tuple, State] = {}
        self._forget()

    def _longest_inside(self, token: bytes) -> int:
        """The longest other token that ``token`` begins with (-1: none)."""
        for end in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:end])
            if rank is not None:
                return rank
        return -1

    def _forget(self) -> None:
        """A state is (last token emitted, positions); a position is (node, tokens not emitted)."""
        for state in self.states.values():
            state.clear()  # states point at each other
        self.kept = 0
        self.states = {}
        self.start = self._state((-1, ((0, ()),)))

    def _state(self, content: tuple) -> State:
        state = self.states.get(content)
        if state is None:
            state = self.states[content] = State()
            state.content = content
        return state

    def merge(self, piece: bytes, least: int = 1) -> list[bytes]:
        """The definition: join the adjacent parts of lowest rank, the leftmost first, down to
        ``least`` parts or until none can be joined."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > least:
            best, at = min(
                (ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1)
            )
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts last joined to make ``token``; none if its bytes never become it."""
        if token not in self.splits:
            parts = self.merge(token, 2)
            self.splits[token] = (parts[0], parts[1]) if len(parts) == 2 else None
            if len(parts) == 2:
                self.regular &= max(map(self.born, parts)) < self.ranks[token]
        return self.splits[token]

    def born(self, token: bytes) -> int:
        """When, in the order of ranks, a part comes into being; bytes are there from the start."""
        return self.ranks[token] if len(token) > 1 else -1

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left`` (-1: begin a piece).

        The parts that meet where the tokens meet are followed backwards in time. Two of them would
        have been joined if their rank came up before either was joined to its other neighbour;
        of equal ranks the left one comes first.
        """
        known = self.pairs.get(left << 32 | right)
        if known is not None:
            return known
        if len(self.pairs) > MOVES_KEPT:
            self.pairs.clear()
        y = self.bytes_of[right]
        if len(y) > 1 and self.split(y) is None:
            known = False
        elif left < 0:
            known = True
        else:
            known = self._apart(self.bytes_of[left], y)
        self.pairs[left << 32 | right] = known
        return known

    def _apart(self, x: bytes, y: bytes) -> bool:
        whole = [x, y]
        x_ends = y_ends = NEVER
        while True:
            rank = self.ranks.get(x + y, NEVER)
            if rank < x_ends and rank <= y_ends and rank != NEVER:
                apart = False
                break
            if self.born(x) > self.born(y):
                x_ends = self.ranks[x]
                x = self.split(x)[1]
            elif len(y) > 1:
                y_ends = self.ranks[y]
                y = self.split(y)[0]
            else:
                apart = True
                break
        # Where a part outranks what it is part of, ranks are not times: go by the definition.
        return apart if self.regular else self.merge(b"".join(whole)) == whole

    def _move(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        emitted, positions = state.content
        tree, facts, pairs = self.tree, self.facts, self.pairs
        alive = []
        here = None
        for node, path in positions:
            following = tree.get(node << 8 | byte)
            if following is None:
                continue
            fact = facts[following]
            if fact & 1:
                alive.append((following, path))
            if here is None and fact >= 0:
                token = fact >> 1
                left = path[-1] if path else emitted
                fits = pairs.get(left << 32 | token)
                if self.fits(left, token) if fits is None else fits:
                    here = (*path, token)
        if here is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        alive.append((0, here))
        out = alive[0][1]
        if out:  # else the oldest position has nothing to emit, and so all have nothing in common
            for _, path in alive:
                agreed = 0
                for one, other in zip(out, path):
                    if one != other:
                        break
                    agreed += 1
                out = out[:agreed]
                if not out:
                    break
        if out:
            emitted = out[-1]
            agreed = len(out)
            alive = [(node, path[agreed:]) for node, path in alive]
        if alive[0][1]:
            emitted = -2  # no position asks any more what came before it
        move = state[byte] = self._state((emitted, tuple(alive))), out
        self.kept += 1
        return move

    def encode(self, piece: bytes) -> list[int]:
        ids = self._walk(piece)
        return self._run(piece) if ids is None else ids

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """The packed ids of each piece. Pieces that leave the deterministic machine run together."""
        packed, left = [], []
        for k, piece in enumerate(pieces):
            ids = self._walk(piece)
            if ids is None and len(piece) <= LONG:
                left.append(k)
            packed.append(array("i", self._run(piece) if ids is None and len(piece) > LONG else ids or ()).tobytes())
        for k, ids in zip(left, self._run_all([pieces[k] for k in left])):
            packed[k] = ids
        return packed

    def _walk(self, piece: bytes) -> list[int] | None:
        """The deterministic machine; none where a move is not determinised yet."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.kept > MOVES_KEPT:
            self._forget()
        state, ids = self.start, []
        for byte in piece:
            move = state.get(byte)
            if move is None or len(move) == 1:
                met = 1 if move is None else move[0] + 1
                if met < VISITS:
                    state[byte] = MET[met]
                    self.kept += met == 1
                    return None
                move = self._move(state, byte)
            state, out = move
            if out:
                ids += out
        ids += state.content[1][-1][1]
        return ids

    def _head(self, head: bytes) -> tuple[int, int]:
        """The node that ``head`` leads to (0: no longer token begins so) and its longest token."""
        node, longest, tree, facts = 0, -1, self.tree, self.facts
        for byte in head:
            node = tree.get(node << 8 | byte, 0)
            if not node:
                break
            fact = facts[node]
            if fact >= 0:
                longest = fact >> 1
            if not fact & 1:
                node = 0
                break
        if len(self.heads) > MOVES_KEPT:
            self.heads.clear()
        known = self.heads[head] = node, longest
        return known

    def _run(self, piece: bytes) -> list[int]:
        """The nondeterministic machine, depth first. A position is reached in one way only."""
        ids: list[int] = []
        dead: set[int] = set()
        size, pairs, heads, sizes, shorter = len(piece), self.pairs, self.heads, self.sizes, self.shorter
        tree, facts = self.tree, self.facts
        begin, left = 0, -1
        while True:
            head = piece[begin : begin + HEAD]
            node, token = heads.get(head) or self._head(head)
            if node:
                for byte in piece[begin + HEAD :]:
                    node = tree.get(node << 8 | byte)
                    if node is None:
                        break
                    fact = facts[node]
                    if fact >= 0:
                        token = fact >> 1
                    if not fact & 1:
                        break
            while True:
                if token < 0:
                    if not ids:
                        raise ValueError(f"the vocabulary has no tokens for {piece!r}")
                    dead.add(begin)
                    token = ids.pop()
                    begin -= sizes[token]
                    left = ids[-1] if ids else -1
                else:
                    end = begin + sizes[token]
                    if end not in dead:
                        fits = pairs.get(left << 32 | token)
                        if self.fits(left, token) if fits is None else fits:
                            break
                token = shorter[token]
            ids.append(token)
            if end == size:
                return ids
            begin, left = end, token

    def _run_all(self, pieces: list[bytes]) -> list[bytes]:
        """:meth:`_run` for many pieces in step: each array holds a value a piece.

        Positions count through all pieces; a byte between them keeps the end of one apart from the
        beginning of the next.
        """
        if len(pieces) < FEW:
            return [array("i", self._run(piece)).tobytes() for piece in pieces]
        if self.together is None:
            self.together = Together(self)
        tokens, late = self.together.run(pieces)
        ends = np.cumsum([len(piece) + 1 for piece in pieces])
        counts = np.cumsum(tokens >= 0)[ends - 1] * tokens.itemsize
        packed = tokens[tokens >= 0].tobytes()
        out = [packed[a:b] for a, b in zip([0, *counts.tolist()], counts.tolist())]
        for k in late:
            out[k] = array("i", self._run(pieces[k])).tobytes()
        return out


class Together:
    """The nondeterministic machine over many pieces at once, depth first like ``Transducer._run``.

    A part is a token by its rank, or a single byte by a number behind all ranks.
    """

    def __init__(self, transducer: Transducer):
        self.transducer = transducer
        ranks = transducer.ranks
        self.bytes_from = max(ranks.values()) + 1
        parts = self.bytes_from + 256
        self.sizes = np.zeros(parts, dtype=np.int64)
        self.shorter = np.full(parts, -1, dtype=np.int64)
        self.born = np.full(parts, -1, dtype=np.int64)
        self.part = np.arange(parts)  # of a token
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
            self.shorter[rank] = transducer.shorter[rank]
            if len(token) > 1:
                self.born[rank] = rank
            else:
                self.part[rank] = self.bytes_from + token[0]
        self.first = np.full(parts, UNKNOWN, dtype=np.int64)  # the two parts of a part; -1: none
        self.second = np.full(parts, UNKNOWN, dtype=np.int64)
        self._tree()
        self._joins()
        self.pairs = np.full(SLOTS, -1, dtype=np.int64)  # twice a pair, plus one if it fits

    def _tree(self) -> None:
        """Moves of the prefix tree as a table; nodes that lead on have the smallest numbers."""
        tree, facts = self.transducer.tree, np.array(self.transducer.facts, dtype=np.int64)
        inner = facts & 1 == 1
        inner[0] = True
        number = np.empty(len(facts), dtype=np.int64)
        self.inner = int(inner.sum())
        number[inner] = np.arange(self.inner)
        number[~inner] = np.arange(self.inner, len(facts))
        self.token_at = np.empty(len(facts), dtype=np.int64)
        self.token_at[number] = facts >> 1
        keys = np.fromiter(tree.keys(), np.int64, len(tree))
        nodes = np.fromiter(tree.values(), np.int64, len(tree))
        self.table = np.zeros(self.inner << 8, dtype=np.int32)  # 0: no such move
        self.table[number[keys >> 8] << 8 | keys & 255] = number[nodes]

    def _joins(self) -> None:
        """All pairs of parts that make a token, sorted, with its rank."""
        ranks, bytes_from = self.transducer.ranks, self.bytes_from
        part_of = {bytes([byte]): bytes_from + byte for byte in range(256)}
        part_of = {**ranks, **part_of}
        pairs, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                one = part_of.get(token[:cut])
                if one is not None:
                    other = part_of.get(token[cut:])
                    if other is not None:
                        pairs.append(one << 32 | other)
                        made.append(rank)
        order = np.argsort(np.array(pairs, dtype=np.int64))
        self.joins = np.append(np.array(pairs, dtype=np.int64)[order], NEVER)
        self.made = np.append(np.array(made, dtype=np.int64)[order], NEVER)

    def run(self, pieces: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """The token that begins at each position (-1: none), and the pieces that were left over."""
        data = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8).astype(np.int64)
        ends = np.cumsum([len(piece) + 1 for piece in pieces]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        tokens = np.full(len(data), -1, dtype=np.int32)
        before = np.full(len(data), -1, dtype=np.int64)  # the token that ends at a position
        dead = np.zeros(len(data), dtype=bool)
        piece, begin, end = np.arange(len(pieces)), starts.copy(), ends
        left, token = np.full(len(pieces), -1), self._longest(data, begin, end)
        while len(piece) >= FEW:
            back = np.flatnonzero(token < 0)
            if len(back):  # nothing fits here: give up the token before
                dead[begin[back]] = True
                lost = left[back]
                if (lost < 0).any():
                    raise ValueError(f"the vocabulary has no tokens for {pieces[piece[back[lost < 0][0]]]!r}")
                begin[back] -= self.sizes[lost]
                tokens[begin[back]] = -1
                left[back] = before[begin[back]]
                token[back] = self.shorter[lost]
            after = begin + self.sizes[token]
            good = token >= 0
            good &= ~dead[np.where(good, after, 0)]
            asked = np.flatnonzero(good)
            good[asked] = self._fits(left[asked], token[asked])
            bad = np.flatnonzero(~good & (token >= 0))
            token[bad] = self.shorter[token[bad]]
            on = np.flatnonzero(good)
            tokens[begin[on]] = token[on]
            before[after[on]] = token[on]
            begin[on] = after[on]
            left[on] = token[on]
            more = on[begin[on] < end[on]]
            token[more] = self._longest(data, begin[more], end[more])
            if len(more) < len(on):
                stay = begin < end
                piece, begin, end, left, token = piece[stay], begin[stay], end[stay], left[stay], token[stay]
        for k in piece:
            tokens[starts[k] : ends[k]] = -1
        return tokens, piece.tolist()

    def _longest(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token at each position (-1: none)."""
        longest = np.full(len(begin), -1)
        at, who, node = begin, np.arange(len(begin)), np.zeros(len(begin), dtype=np.int64)
        while len(who):
            node = self.table[node << 8 | data[at]].astype(np.int64)
            token = self.token_at[node]
            found = np.flatnonzero((token >= 0) & (node > 0))
            longest[who[found]] = token[found]
            at = at + 1
            on = np.flatnonzero((node > 0) & (node < self.inner) & (at < end[who]))
            at, who, node = at[on], who[on], node[on]
        return longest

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``Transducer.fits`` of many pairs; what was asked of late is kept."""
        asked = (left + 1) << 32 | right
        slot = (asked * 0x1E3779B97F4A7C15 >> 40) & (SLOTS - 1)
        kept = self.pairs[slot]
        out = kept & 1 == 1
        new = np.flatnonzero(kept >> 1 != asked)
        if len(new):
            pairs, back = np.unique(asked[new], return_inverse=True)
            out[new] = self._told((pairs >> 32) - 1, pairs & 0xFFFFFFFF)[back]
            self.pairs[slot[new]] = asked[new] << 1 | out[new]
        return out

    def _told(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        x, y = self.part[left], self.part[right]
        self._split(y)
        out = (self.first[y] >= 0) | (y >= self.bytes_from)
        who = np.flatnonzero(out & (left >= 0))
        x, y = x[who], y[who]
        x_ends, y_ends = np.full(len(who), NEVER), np.full(len(who), NEVER)
        inner = who
        while len(who):
            rank = self._made(x, y)
            joined = (rank < x_ends) & (rank <= y_ends) & (rank != NEVER)
            out[who[joined]] = False
            x_born, y_born = self.born[x], self.born[y]
            on = np.flatnonzero(~joined & ((x_born >= 0) | (y_born >= 0)))
            who, x, y, x_ends, y_ends, x_born, y_born = (
                values[on] for values in (who, x, y, x_ends, y_ends, x_born, y_born)
            )
            older = x_born > y_born
            self._split(np.where(older, x, y))
            x_ends, y_ends = np.where(older, x_born, x_ends), np.where(older, y_ends, y_born)
            x, y = np.where(older, self.second[x], x), np.where(older, y, self.first[y])
        if not self.transducer.regular:
            fits = self.transducer.fits
            out[inner] = [fits(a, b) for a, b in zip(left[inner].tolist(), right[inner].tolist())]
        return out

    def _split(self, parts: np.ndarray) -> None:
        """Looks up the two parts of ``parts`` that were not asked for before."""
        for part in set(parts[self.first[parts] == UNKNOWN].tolist()):
            two = None
            if part < self.bytes_from:
                two = self.transducer.split(self.transducer.bytes_of[part])
            self.first[part], self.second[part] = map(self._part, two) if two else (-1, -1)

    def _part(self, part: bytes) -> int:
        return self.transducer.ranks[part] if len(part) > 1 else self.bytes_from + part[0]

    def _made(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of the token that two parts make (``NEVER``: none)."""
        asked = x << 32 | y
        at = np.searchsorted(self.joins, asked)
        return np.where(self.joins[at] == asked, self.made[at], NEVER)


class Encoder:
    """Cuts texts into the matches of a pattern and encodes each on its own.

    The packed ids of plain words are kept: what was met of late, and before that. The older part is
    dropped when the newer is full, so that common words stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}  # of words with the blank before them
        self.before: dict[str, bytes] = {}
        self.matches: dict[str, bytes] = {}  # of other matches
        # Single marks that may end a word.
        alone = all(self.pattern.findall(f" ab{mark}") == [" ab", mark] for mark in MARKS)
        self.marks = set(MARKS) if alone else set()
        self.line = self.pattern.findall("a\nb") == ["a", "\n", "b"]

    @staticmethod
    def _plain(word: str) -> bool:
        """Whether a blank and ``word`` are one match, since it is of Latin letters."""
        return word.isalpha() and (word.isascii() or max(word) < OTHER_LETTERS)

    def _parts(self, piece: str) -> list[str]:
        """The matches in a blank and the visible characters after it.

        Latin letters are one match with their blank, a mark behind them and a line end between
        visible characters are matches of their own. Everything else goes through the pattern.
        """
        if self._plain(piece):
            return [" " + piece]
        if piece[-1:] in self.marks and self._plain(piece[:-1]):
            return [" " + piece[:-1], piece[-1]]
        if self.line and piece.count("\n") == 1:
            left, right = piece.split("\n")
            if left and right and not left[-1].isspace() and not right[0].isspace():
                return [*self._parts(left), "\n", *self._matches(right)]
        return self._matches(" " + piece)

    def _matches(self, text: str) -> list[str]:
        return [text] if self._plain(text) else self.pattern.findall(text)

    def _codes(self, words: set[str], matches: set[str]) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """The packed ids of plain words with the blank before them, and of other matches.

        What is not known is encoded together, and kept if it is short.
        """
        known, before, kept = self.known, self.before, self.matches
        coded, codes = {}, {}
        for word in words:
            packed = known.get(word)
            if packed is None and (packed := before.get(word)) is not None:
                known[word] = packed
            coded[word] = packed
        for match in matches:
            packed = kept.get(match)
            if packed is None and match[:1] == " ":
                packed = known.get(match[1:]) or before.get(match[1:])
            codes[match] = packed
        new = [word for word, packed in coded.items() if packed is None]
        others = [match for match, packed in codes.items() if packed is None]
        pieces = [b" " + word.encode() for word in new] + [match.encode() for match in others]
        packed = self.transducer.encode_all(pieces)
        for keys, values, all_of, keep in (
            (new, packed[: len(new)], coded, known),
            (others, packed[len(new) :], codes, kept),
        ):
            all_of.update(zip(keys, values))
            keep.update((key, value) for key, value in zip(keys, values) if len(key) < 64)
        return coded, codes

    @staticmethod
    def cut_at_blanks(text: str) -> bool:
        """Whether every blank stands between visible characters, and there is no unusual white space."""
        if not text or text[-1] == " " or any(space in text for space in OTHER_SPACES):
            return False
        if any(space in text for space in "\t\x0b\x0c\r"):
            return not BLANK_BESIDE.search(text)
        return not ("  " in text or " \n" in text or "\n " in text)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.

        A match never runs from a visible character into white space, and what matches in white
        space depends on it and the next character only. Single blanks between visible characters
        are therefore cuts; texts with a blank beside other white space or at the end, or with unusual
        white space, are matched whole.
        """
        if len(self.known) > WORDS_KEPT:
            self.before, self.known = self.known, {}
        if len(self.matches) > WORDS_KEPT:
            self.matches.clear()
        known, marks, plain = self.known, self.marks, self._plain
        cuts = [text.split(" ") if self.cut_at_blanks(text) else [text] for text in texts]
        heads = [self._matches(cut.pop(0)) for cut in cuts]
        packed: dict[str, bytes] = {}  # of each piece behind a blank
        words, marked, parts = set(), [], {}
        for piece in set().union(*cuts):
            ids = known.get(piece)
            if ids is not None:
                packed[piece] = ids
            elif plain(piece):
                words.add(piece)
            elif piece[-1:] in marks and ((word := piece[:-1]) in known or plain(word)):
                marked.append(piece)
                words.add(word)
            else:
                parts[piece] = self._parts(piece)
        coded, codes = self._codes(words, marks.union(*heads, *parts.values()))
        packed.update(coded)
        for piece in marked:
            packed[piece] = coded[piece[:-1]] + codes[piece[-1]]
        for piece, matches in parts.items():
            packed[piece] = b"".join([codes[match] for match in matches])
        rows = [b"".join([*map(codes.__getitem__, a), *map(packed.__getitem__, b)]) for a, b in zip(heads, cuts)]
        return [np.frombuffer(row, dtype=np.int32) for row in rows]


class Utf8Machine:
    """Turns bytes into text as they come; what is not UTF-8 becomes U+FFFD, one for each longest
    beginning of a character."""

    @staticmethod
    def follows(pending: bytes) -> tuple[int, int]:
        """The least and greatest byte that may follow an unfinished character."""
        if len(pending) == 1:
            return {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
                pending[0], (0x80, 0xBF)
            )
        return 0x80, 0xBF

    @staticmethod
    def length(lead: int) -> int:
        """Bytes of the character that ``lead`` begins; 0 if none begins with it."""
        if lead < 0x80:
            return 1
        if 0xC2 <= lead <= 0xDF:
            return 2
        if 0xE0 <= lead <= 0xEF:
            return 3
        return 4 if 0xF0 <= lead <= 0xF4 else 0

    @classmethod
    def feed(cls, pending: bytes, data: bytes) -> tuple[str, bytes]:
        """The text that is complete after ``data``, and the new state."""
        out = []
        for i in range(len(data)):
            byte = data[i : i + 1]
            if pending:
                low, high = cls.follows(pending)
                if low <= byte[0] <= high:
                    pending += byte
                    if len(pending) == cls.length(pending[0]):
                        out.append(pending.decode())
                        pending = b""
                    continue
                out.append("�")
                pending = b""
            size = cls.length(byte[0])
            if size == 1:
                out.append(byte.decode())
            elif size:
                pending = byte
            else:
                out.append("�")
        return "".join(out), pending


class Decoder:
    """Ids to text, a token at a time."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.moves: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        # Moves from the state between characters back to it: texts of the tokens of whole characters.
        self.whole = np.full(max(self.bytes_of, default=-1) + 1, None, dtype=object)
        for rank, token in self.bytes_of.items():
            text, pending = Utf8Machine.feed(b"", token)
            if not pending:
                self.whole[rank] = text
        self.odd = np.array([text is None for text in self.whole], dtype=bool)

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        pending = b""
        table = self.moves[pending]
        for token in ids:
            move = table.get(token)
            if move is None:
                move = table[token] = Utf8Machine.feed(pending, self.bytes_of[token])
                if move[1] not in self.moves:
                    self.moves[move[1]] = {}
            if move[1] is not pending:
                pending = move[1]
                table = self.moves[pending]
            yield move[0]
        if pending:
            yield "�"

    def decode(self, ids: np.ndarray) -> str:
        """The text of all ids at once.

        Between characters, ids that end between characters again are looked up alone; the others
        and what follows them, up to the end of a character, go through the machine.
        """
        if not len(ids) or ids.min() < 0 or ids.max() >= len(self.whole):
            return "".join(self.stream(ids.tolist()))
        texts = self.whole[ids].tolist()
        odd = np.flatnonzero(self.odd[ids]).tolist()
        if not odd:
            return "".join(texts)
        out, at, pending, moves = [], 0, b"", self.moves
        for begin in odd:
            if begin < at:
                continue
            out += texts[at:begin]
            for at in range(begin, len(texts)):
                token = int(ids[at])
                move = moves[pending].get(token)
                if move is None:
                    move = moves[pending][token] = Utf8Machine.feed(pending, self.bytes_of[token])
                    moves.setdefault(move[1], {})
                text, pending = move
                out.append(text)
                if not pending:
                    break
            at += 1
        return "".join(out + texts[at:]) + ("�" if pending else "")


def _lines(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _appended(df: DataFrame, column: str, kind: T.DataType) -> T.StructType:
    kept = [f for f in df.schema if f.name.lower() != column.lower()]
    return T.StructType([*kept, T.StructField(column, kind)])


def _list_column(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    values = np.concatenate([np.empty(0, dtype=np.int32), *ids])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, ROWS):
            yield whole.slice(begin, ROWS)


def _blocks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Slices of about ``BLOCK`` bytes of text, of one row at least."""
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes + 64, dtype=np.int64)  # rows without text count a little
        begin = 0
        while begin < whole.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
            yield whole.slice(begin, end - begin)
            begin = end


def encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", to: str = "tokens"
) -> DataFrame:
    """Adds the token ids of ``text``; a column of that name is replaced.

    ``vocabulary`` is the path of a ``.tiktoken`` file on the driver; its lines (the vocabulary's
    size bounds them) are broadcast. A null or empty text has no tokens. Texts are never cut.
    """
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(_lines(vocabulary))
    schema = _appended(df, to, T.ArrayType(T.IntegerType()))
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = shared.value
        encoder = held(("encoder", lines, pattern), lambda: Encoder(read_ranks(lines), pattern))
        for batch in _blocks(batches, text):
            column = _list_column(encoder.encode_all([t or "" for t in batch.column(text).to_pylist()]))
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), column], schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, tokens: str = "tokens", to: str = "decoded") -> DataFrame:
    """Adds the text of the token ids; a column of that name is replaced. No tokens: an empty text."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(_lines(vocabulary))
    schema = _appended(df, to, T.StringType())
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = shared.value
        decoder = held(("decoder", lines), lambda: Decoder(read_ranks(lines)))
        for batch in _sliced(batches):
            lists = batch.column(tokens)
            none = np.empty(0, dtype=np.int32)
            texts = [decoder.decode(v.values.to_numpy(zero_copy_only=False) if v.is_valid else none) for v in lists]
            column = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), column], schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``tokens`` and ``decoded``, as :func:`encode` and :func:`decode` after each other.

    Both run in one pass and so in one worker per task: half the workers have half the caches, and
    each sees twice the texts.
    """
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(_lines(vocabulary))
    df = df.drop("tokens", "decoded")
    schema = T.StructType(
        [
            *df.schema,
            T.StructField("tokens", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def both(lines: bytes) -> tuple[Encoder, Decoder]:
        ranks = read_ranks(lines)
        return Encoder(ranks, pattern), Decoder(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = shared.value
        encoder, decoder = held(("round trip", lines, pattern), lambda: both(lines))
        for batch in _blocks(batches, text):
            ids = encoder.encode_all([t or "" for t in batch.column(text).to_pylist()])
            texts = pa.array([decoder.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, _list_column(ids), texts], schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, tokens: str = "tokens", decoded: str = "decoded") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256."""
    ids = F.array_join(F.col(tokens).cast("array<string>"), ",")
    return df.withColumns(
        {
            "n_tokens": F.size(tokens).cast("long"),
            "ids_sha256": F.sha2(ids, 256),
            "decoded_sha256": F.sha2(F.col(decoded), 256),
        }
    )
