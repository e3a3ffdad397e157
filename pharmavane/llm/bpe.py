"""Byte-level BPE as a streaming transducer with bounded lookahead.

Text comes in pieces. ``Encoder`` cuts it into words as soon as a cut cannot change
any more; ``Transducer`` reads a word byte by byte and keeps, for each of
the last few positions, the encoding of the prefix that ends there. By the
structure of merge lists that encoding is one earlier encoding and one more token,
and a token that all the kept encodings share is final. Emission goes by this
convergence. ``MergeList.lookahead`` bounds how many bytes it takes, so the state is
constant whatever the length of a word, but no encoding waits for that many: the
bound is computed in the tests only. Words of up to ``SHORT`` characters are encoded
whole. ``Decoder`` is the inverse state machine, ids to text.

Everything derives from the tokenizer file, whose path is a parameter.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed: the published pattern that cuts text for byte-level tokens.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD = regex.compile(
    rf"{CONTRACTIONS}| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{White_Space}}\p{{L}}\p{{N}}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# What continues a word, by the class of its characters.
SPACE_RUN = regex.compile(r"\p{White_Space}*")
RUNS = [regex.compile(r"\p{L}*"), regex.compile(r"\p{N}*"), regex.compile(r"[^\p{White_Space}\p{L}\p{N}]*"), SPACE_RUN]
# A space before anything but white space always begins a word.
BORDER, UNEVEN = re.compile(r" (?=\S)"), re.compile(r" \s| $")
CHUNK = 1 << 16  # characters of text taken at a time
SHORT = 32  # words of at most so many characters are encoded whole, and remembered
REMEMBERED = 1 << 19  # entries of a worker's memories, each
INFINITE = 1 << 60
START = -1  # in place of a token, before the first


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes in order
    for the characters from U+0100.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class MergeList:
    """The vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = byte_symbols()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {
            i: bytes(symbols[c] for c in token) for token, i in vocab.items() if token not in self.special
        }
        self.ids = {b: i for i, b in self.bytes.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, token
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        for rank, pair in enumerate(merges):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            token = vocab[left + right]
            self.merge[vocab[left], vocab[right]] = rank, token
            self.parts.setdefault(token, (rank, vocab[left], vocab[right]))
        self.longest = max(map(len, self.ids))
        self._edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self._valid: dict[int, bool] = {}
        self.joins: dict[tuple[int, int], bool] = {}  # follows() so far
        self.usable = {b: i for b, i in self.ids.items() if self.valid(i)}
        self.reach: dict[bytes, int] = {}  # first three bytes -> longest usable token with them
        for spelled in self.usable:
            if len(spelled) > 2:
                self.reach[spelled[:3]] = max(len(spelled), self.reach.get(spelled[:3], 0))
        self.text_of = dict(self.bytes) | {i: t.encode() for t, i in self.special.items()}

    def lookahead(self) -> int:
        """Bytes after a position that suffice to fix the token there.

        A change at the end of the text reaches back only along a chain of merges,
        each overlapping the one after it and of lower rank; a link of the chain
        spans at most the longest token.
        """
        chain: dict[bytes, int] = {}  # prefix -> longest chain of an earlier merge with it
        most = 1
        for token in sorted(self.parts, key=lambda t: self.parts[t][0]):
            spelled = self.bytes[token]
            length = 1 + max(chain.get(spelled[i:], 0) for i in range(1, len(spelled)))
            most = max(most, length)
            for i in range(1, len(spelled) + 1):
                if chain.get(spelled[:i], 0) < length:
                    chain[spelled[:i]] = length
        return most * self.longest

    def _edge(self, token: int, left: bool) -> list[tuple[int, int]]:
        """The tokens once at an edge of ``token``, and the rank of the merge that took each."""
        found = self._edges.get((token, left))
        if found is None:
            found, at, taken = [], token, INFINITE
            while True:
                found.append((at, taken))
                if at not in self.parts:
                    break
                taken, a, b = self.parts[at]
                at = a if left else b
            self._edges[token, left] = found
        return found

    def _apart(self, first: int, second: int, until: int) -> bool:
        """No merge across the border of the two before rank ``until``.

        Of two merges of one rank the left one comes first, so a merge across the
        border beats an equal one inside the second token but not inside the first.
        """
        for a, a_taken in self._edge(first, left=False):
            for b, b_taken in self._edge(second, left=True):
                across = self.merge.get((a, b))
                if across and across[0] < min(a_taken, until) and across[0] <= b_taken:
                    return False
        return True

    def valid(self, token: int) -> bool:
        """Whether the token's own bytes encode to it alone."""
        found = self._valid.get(token)
        if found is None:
            found = True
            if token in self.parts:
                rank, a, b = self.parts[token]
                found = self.valid(a) and self.valid(b) and self._apart(a, b, rank)
            self._valid[token] = found
        return found

    def follows(self, first: int, second: int) -> bool:
        """Whether the two stand side by side in the encoding of their bytes."""
        found = self.joins.get((first, second))
        if found is None:
            if len(self.joins) >= REMEMBERED:
                self.joins.clear()
            found = self.joins[first, second] = self._apart(first, second, INFINITE)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """A short word: the one way to cover it by tokens that may follow each other.

        Longest tokens are tried first; a dead end steps back.
        """
        usable, reach, joins, size = self.usable, self.reach, self.joins, len(word)
        tokens, ends, tries = [], [0], [size]  # tries: the end to try next, for each step
        while ends[-1] < size:
            at = ends[-1]
            end = min(tries[-1], at + reach.get(word[at : at + 3], 2))
            while end > at:
                token = usable.get(word[at:end])
                if token is not None:
                    if not tokens:
                        break
                    pair = tokens[-1], token
                    if joins[pair] if pair in joins else self.follows(*pair):
                        break
                end -= 1
            if end > at:
                tries[-1] = end - 1
                tokens.append(token)
                ends.append(end)
                tries.append(size)
            else:
                tokens.pop()
                ends.pop()
                tries.pop()
        return tokens


class _Node:
    """The encoding of a prefix: that of a shorter prefix, and one token."""

    __slots__ = ("before", "token", "end")

    def __init__(self, before: _Node | None, token: int, end: int):
        self.before, self.token, self.end = before, token, end


class Transducer:
    """Encodes one word of any length, fed in pieces, with constant state."""

    def __init__(self, merges: MergeList):
        self.merges, self.root = merges, _Node(None, START, 0)
        self.nodes: deque[_Node] = deque([self.root], maxlen=merges.longest)
        self.tail, self.end = b"", 0

    def feed(self, piece: bytes) -> list[int]:
        """Take bytes; return the tokens that have become final."""
        merges, out = self.merges, []
        for i in range(len(piece)):
            self.tail = (self.tail + piece[i : i + 1])[-merges.longest :]
            self.end += 1
            self.nodes.append(self._next())
            if self.end % (2 * merges.longest) == 0:
                out += self._settle()
        return out

    def _next(self) -> _Node:
        """The encoding of one more byte; exactly one last token fits."""
        for size in range(len(self.tail), 0, -1):
            token = self.merges.usable.get(self.tail[-size:])
            if token is not None:
                before = self.nodes[-size]
                if before.token == START or self.merges.follows(before.token, token):
                    return _Node(before, token, self.end)
        raise ValueError("the vocabulary does not hold every byte")

    def _settle(self) -> list[int]:
        """Tokens that all kept encodings share: step back from the furthest until all meet."""
        ways = {node.end: node for node in self.nodes}
        ends = [-end for end in ways]
        heapq.heapify(ends)
        while len(ends) > 1:
            before = ways[-heapq.heappop(ends)].before
            if before.end not in ways:
                ways[before.end] = before
                heapq.heappush(ends, -before.end)
        return self._emit(ways[-ends[0]])

    def _emit(self, upto: _Node) -> list[int]:
        out, node = [], upto
        while node is not self.root:
            out.append(node.token)
            node = node.before
        self.root, upto.before = upto, None
        return out[::-1]

    def finish(self) -> list[int]:
        return self._emit(self.nodes[-1])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Spaced(dict):
    """Ids of a space and what follows it up to the next, from the words they hold."""

    def __init__(self, words: Memory):
        super().__init__()
        self.words = words

    def __missing__(self, part: str) -> bytes:
        found = b"".join(map(self.words.__getitem__, WORD.findall(" " + part)))
        if len(part) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = found
        return found


class Memory(dict):
    """Ids of the short words met so far; never more than ``REMEMBERED``."""

    def __init__(self, merges: MergeList):
        super().__init__()
        self.merges, self.spaced = merges, Spaced(self)

    def __missing__(self, word: str) -> bytes:
        if len(word) > SHORT:
            long = Transducer(self.merges)
            return _packed(long.feed(word.encode()) + long.finish())
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = _packed(self.merges.encode_word(word.encode()))
        return found


class Encoder:
    """Text to ids, piece by piece; ids come out as little-endian 32-bit bytes."""

    def __init__(self, merges: MergeList, memory: Memory | None = None):
        self.merges = merges
        self.memory = Memory(merges) if memory is None else memory
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None
        self.rest = ""  # text whose cut into words may still change
        self.word: Transducer | None = None  # a word longer than a chunk, still open
        self.run: regex.Pattern | None = None  # what continues it

    def feed(self, text: str) -> bytes:
        """Ids of the words that no later text can change."""
        return self._take(text, last=False)

    def finish(self) -> bytes:
        return self._take("", last=True)

    def _take(self, text: str, last: bool) -> bytes:
        """Cut at special tokens; what may be the start of one is held back."""
        text, self.rest = self.rest + text, ""
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += [self._plain(text[at : m.start()], True), _packed([self.merges.special[m[0]]])]
            at = m.end()
        end = len(text)
        if not last:
            end -= next(
                (n for n in range(min(end - at, max(map(len, self.merges.special), default=1) - 1), 0, -1)
                 if any(s.startswith(text[-n:]) for s in self.merges.special)), 0)
        out.append(self._plain(text[at:end], last))
        self.rest += text[end:]
        return b"".join(out)

    def _plain(self, text: str, last: bool) -> bytes:
        """Text without special tokens; what stays open is left in ``rest``."""
        out = []
        if self.word:
            done = self.run.match(text).end()
            ended = done < len(text) or last
            # The last space of a run belongs to the next word, if there is one.
            take = done - 1 if self.run is SPACE_RUN and done and not (last and done == len(text)) else done
            out.append(_packed(self.word.feed(text[:take].encode())))
            text = text[take:]
            if not ended:
                self.rest = text
                return b"".join(out)
            out.append(_packed(self.word.finish()))
            self.word = self.run = None
        cut = len(text)
        if not last:  # the last border that no later text can move
            cut = text.rfind(" ", 0, max(0, cut - 1))
            cut = cut if cut >= 0 and not text[cut + 1].isspace() else 0
        if cut:
            head = text[:cut]
            first, *spaced = BORDER.split(head) if UNEVEN.search(head) else head.split(" ")
            out.append(b"".join(map(self.memory.__getitem__, WORD.findall(first))))
            out.append(b"".join(map(self.memory.spaced.__getitem__, spaced)))
        if not last:
            words, kept = WORD.findall(text, cut), len(text)
            while words and kept > len(text) - 2:  # a word is final when two more characters are known
                kept -= len(words.pop())
            self.rest = text[kept:]
            out.append(b"".join(map(self.memory.__getitem__, words)))
        # A contraction, of 3 characters at most, is whole: what follows begins another word.
        if len(self.rest) > max(CHUNK, 3) and WORD.match(self.rest).end() == len(self.rest):
            out.append(self._open())
        return b"".join(out)

    def _open(self) -> bytes:
        """Begin a word that is longer than a chunk."""
        word = self.rest
        self.run = next(run for run in RUNS if run.fullmatch(word, 1) and run.match(word, 1).end() > 1)
        take = len(word) - 1 if self.run is SPACE_RUN else len(word)
        self.word, self.rest = Transducer(self.merges), word[take:]
        return _packed(self.word.feed(word[:take].encode()))


class Decoder:
    """Ids to text, piece by piece: an incomplete character waits for its bytes."""

    def __init__(self, merges: MergeList):
        self.text_of, self.state = merges.text_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        """Text whose bytes are whole; unknown ids give nothing, bad bytes U+FFFD."""
        return self.state.decode(b"".join([self.text_of.get(i, b"") for i in ids]))

    def finish(self) -> str:
        return self.state.decode(b"", True)


@cache
def load(path: str) -> MergeList:
    return MergeList(path)


@cache
def memory_of(path: str) -> Memory:
    """The words met by this worker."""
    return Memory(load(path))


def encode_text(text: str, path: str) -> Iterator[bytes]:
    """Ids of a text as little-endian 32-bit bytes, in pieces."""
    encoder = Encoder(load(path), memory_of(path))
    for at in range(0, len(text), CHUNK):
        yield encoder.feed(text[at : at + CHUNK])
    yield encoder.finish()


COLUMNS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    ids: bool = False, decoded: bool = False,
) -> DataFrame:
    """Encode and decode every text: token counts and digests, on request also
    ``ids`` (binary, little-endian 32-bit) and ``decoded`` (the text read back).

    Null and empty texts have no tokens; ids may be null or repeated; further
    columns are left out. One pass without a shuffle. Digests grow piece by piece,
    so a task holds one Arrow batch and a piece; the requested columns hold a
    whole text.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    schema = COLUMNS + ", ids binary" * ids + ", decoded string" * decoded
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.binary())] * ids + [("decoded", pa.string())] * decoded

    def one(text: str) -> tuple:
        taken, read, n = hashlib.sha256(), hashlib.sha256(), 0
        decoder, kept_ids, kept_text = Decoder(load(path)), [], []
        for piece in encode_text(text, path):
            n += len(piece) // 4
            taken.update(piece)
            back = decoder.feed(np.frombuffer(piece, "<u4").tolist())
            read.update(back.encode())
            if ids:
                kept_ids.append(piece)
            if decoded:
                kept_text.append(back)
        back = decoder.finish()
        read.update(back.encode())
        out = n, taken.hexdigest(), read.hexdigest()
        return out + (b"".join(kept_ids),) * ids + ("".join([*kept_text, back]),) * decoded

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(text.as_py() or "") for text in batch.column(1)]
            columns = list(zip(*found)) if found else [[]] * (len(fields) - 1)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema=pa.schema(fields))

    return rows.mapInArrow(run, schema)
