"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine.

A merge list of increasing ranks gives each text one segmentation. Text that follows can change the segmentation of what
was read only through a chain of merges of growing rank that walks to the left, one left component at a time, so the longest
such chain bounds how far back a change can reach (``Merges.lookahead``, computed from the list). Tokens that end before that
distance are final: they are emitted, and only the bytes after them are kept. What is kept is thus bounded by the list,
not by the text. The normaliser and the splitter are those the tokenizer file names."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import segments, text_of

BLOCK = 4096  # characters, or symbols of one word, read before what is final is emitted
CARRY = 64  # characters of an unfinished part kept for the splitter; longer than any contraction
MEMO_BYTES, MEMO_ENTRIES = 64, 400_000  # chunks up to this size are remembered, this many per Python worker


def byte_alphabet() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Merges:
    """The merge list of a byte-level tokenizer file: ids of symbols, ranks of pairs, and the lookahead they need."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.vocab = vocab
        letters = byte_alphabet()
        self.plain = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        size = dict.fromkeys((*letters, *(c + suffix for c in letters)), 1)
        lefts: dict[str, list[str]] = {}
        self.wide = max(vocab.values()) + 1
        self.rank: dict[int, int] = {}  # by left * wide + right
        self.made: list[int] = []  # by rank
        reach: dict[str, int] = {}  # longest chain whose latest merge has this left component
        self.lookahead = 0
        for rank, (left, right) in enumerate(merges):
            if left not in size or right not in size:
                raise ValueError(f"merge {rank} uses a token that no earlier merge makes")
            joined = left + (right if not suffix or not left.endswith(suffix) else right)
            self.rank.setdefault(vocab[left] * self.wide + vocab[right], rank)
            self.made.append(vocab[joined])
            far, heads = 0, [right]
            while heads:
                head = heads.pop()
                far = max(far, reach.get(head, 0))
                heads += lefts.get(head, ())
            reach[left] = max(reach.get(left, 0), far + size[left])
            self.lookahead = max(self.lookahead, reach[left])
            lefts.setdefault(joined, []).append(left)
            size[joined] = size[left] + size[right]
        self.size = {vocab[t]: n for t, n in size.items()}

    def merge(self, symbols: list[int]) -> list[int]:
        """The segmentation of a run of symbols: the pair of least rank first, the leftmost of equal ones first."""
        return self._short(symbols) if len(symbols) <= 100 else self._long(symbols)

    def _short(self, ids: list[int]) -> list[int]:
        rank, wide, none = self.rank.get, self.wide, len(self.made)
        ids = list(ids)
        ranks = [rank(a * wide + b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            joined = self.made[best]
            ids[i:i + 2] = (joined,)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(joined * wide + ids[i + 1], none)
            if i:
                ranks[i - 1] = rank(ids[i - 1] * wide + joined, none)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        rank, wide, n = self.rank, self.wide, len(ids)
        ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[a * wide + b], i) for i, (a, b) in enumerate(zip(ids, ids[1:])) if a * wide + b in rank]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or rank.get(ids[i] * wide + ids[j]) != best:
                continue
            ids[i], ids[j], k = self.made[best], -1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if ids[i] * wide + ids[k] in rank:
                    heapq.heappush(heap, (rank[ids[i] * wide + ids[k]], i))
            h = before[i]
            if h >= 0 and ids[h] * wide + ids[i] in rank:
                heapq.heappush(heap, (rank[ids[h] * wide + ids[i]], h))
        return [x for x in ids if x >= 0]


class WordStream:
    """One word read in parts: ``push`` gives the tokens that nothing after them can change, ``finish`` the others."""

    def __init__(self, merges: Merges, block: int = BLOCK):
        self.merges, self.block, self.held = merges, block, b""

    def push(self, part: bytes) -> list[int]:
        out = []
        for at in range(0, len(part), self.block):
            self.held += part[at:at + self.block]
            if len(self.held) > self.block + self.merges.lookahead:
                out += self._settle()
        return out

    def _settle(self) -> list[int]:
        known = self.held[:-1]  # the last symbol has another id if the word ends with it
        out, at = [], 0
        for token in self.merges.merge([self.merges.plain[b] for b in known]):
            end = at + self.merges.size[token]
            if end > len(known) - self.merges.lookahead:
                break
            out.append(token)
            at = end
        self.held = self.held[at:]
        return out

    def finish(self) -> list[int]:
        word, self.held = self.held, b""
        if not word:
            return []
        symbols = [self.merges.plain[b] for b in word]
        symbols[-1] = self.merges.last[word[-1]]
        return self.merges.merge(symbols)


def _cut(text: str, at: int) -> int:
    """The first place from ``at`` on where the text may be normalised in two parts (before a character that joins none before it)."""
    while at < len(text):
        c = text[at]
        if c.isascii() or not (unicodedata.combining(c) or unicodedata.category(c)[0] in "MC" or "\u1100" <= c <= "\u11ff"
                               or unicodedata.category(c) == "Lo" and c > "\uffff" or not unicodedata.is_normalized("NFC", c)):
            return at
        at += 1
    return at


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Encoder:
    """Texts to token ids, as the tokenizer file defines them, without special tokens added.

    The file must hold a byte-level BPE whose splitter drops white space; strings of its added tokens in a text are those tokens."""

    def __init__(self, path: str, block: int = BLOCK):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, whole = spec["model"], Tokenizer.from_file(path)
        if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("a plain byte-level BPE file is needed")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.normal, self.split, self.block = whole.normalizer, whole.pre_tokenizer, block
        if "".join(t for t, _ in self.split.pre_tokenize_str(" a b ")) != "ab":
            raise ValueError("the splitter must drop white space")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.added, key=len, reverse=True)) or "(?!)")
        self.code = {c: b for b, c in enumerate(byte_alphabet())}
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[bytes, bytes] = {}
        letters = [c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº"]
        plain = all(self._parts(c) == self._parts(c.lower()) and len(self._parts(c + c + ".,;:!?")) == 2 for c in letters)
        self.simple = re.compile(f"([{''.join(letters)}]+)([.,;:!?]*)" if plain else "(?!)")

    def _parts(self, text: str) -> list[str]:
        return [t for t, _ in self.split.pre_tokenize_str(self.normal.normalize_str(text) if self.normal else text)]

    def _word(self, raw: bytes) -> bytes:
        ids = self.words.get(raw)
        if ids is None:
            word = WordStream(self.merges, self.block)
            ids = _packed(word.push(raw) + word.finish())
            if len(raw) <= MEMO_BYTES:
                if len(self.words) >= MEMO_ENTRIES:
                    self.words.clear()
                self.words[raw] = ids
        return ids

    def _words(self, text: str) -> bytes:
        return b"".join([self._word(bytes(map(self.code.__getitem__, part))) for part in self._parts(text)])

    def _stream(self, text: str) -> Iterator[bytes]:
        """Ids of a text without added tokens, read block by block."""
        if len(text) <= self.block:
            yield self._words(text)
            return
        at, carry, word = 0, "", None  # carry: the unfinished part's normal form, or its end if ``word`` holds what came before
        while at < len(text):
            end = _cut(text, at + self.block)
            piece = text[at:end]
            piece = carry + (self.normal.normalize_str(piece) if self.normal else piece)
            at = end
            found = self.split.pre_tokenize_str(piece)
            if not found:
                carry = piece[-CARRY:] if at < len(text) else ""
                continue
            if at < len(text) and found[-1][1][1] == len(piece):
                # the last two parts may yet become one: an apostrophe and the letter after it
                keep = 2 if len(found) > 1 and found[-2][1][1] == found[-1][1][0] and found[-1][1][1] - found[-2][1][0] <= CARRY else 1
            else:
                keep = 0
            done, open_ = found[:len(found) - keep], found[len(found) - keep:]
            out = b""
            for part, _ in done:
                raw = bytes(map(self.code.__getitem__, part))
                if word is not None:
                    out += _packed(word.push(raw) + word.finish())
                    word = None
                else:
                    out += self._word(raw)
            carry = piece[open_[0][1][0]:] if open_ else ""
            if len(carry) > 2 * CARRY:
                if word is None:
                    word = WordStream(self.merges, self.block)
                out += _packed(word.push(carry[:-CARRY].encode()))
                carry = carry[-CARRY:]
            yield out
        # a part that reaches the end of the text is never kept, so nothing is left over

    def chunk(self, raw: bytes) -> bytes:
        """Ids (little-endian unsigned 32-bit) of a chunk without ASCII white space."""
        ids = self.chunks.get(raw)
        if ids is None:
            text = raw.decode("utf-8", "replace")
            simple = self.simple.fullmatch(text)
            if simple:  # a run of letters, then one of points: the parts the splitter finds
                ids = self._word(simple[1].lower().encode()) + (self._word(simple[2].encode()) if simple[2] else b"")
            elif self.special.search(text):
                ids = b"".join(self._chunk_blocks(raw))
            else:
                ids = self._words(text)
            if len(raw) <= MEMO_BYTES:
                if len(self.chunks) >= MEMO_ENTRIES:
                    self.chunks.clear()
                self.chunks[raw] = ids
        return ids

    def _chunk_blocks(self, raw: bytes) -> Iterator[bytes]:
        text, at = raw.decode("utf-8", "replace"), 0
        for hit in [*self.special.finditer(text), None]:
            for ids in self._stream(text[at:hit.start() if hit else len(text)]):
                yield ids
            if hit:
                yield _packed([self.added[hit[0]]])
                at = hit.end()

    def blocks(self, text: bytes) -> Iterator[bytes]:
        """Ids of a text in blocks, each emitted as soon as it is final. No token joins characters across white space."""
        for _, _, part in segments(text, 0):
            short = []
            for raw in part.split():
                if len(raw) <= self.block:
                    short.append(self.chunk(raw))
                else:
                    yield b"".join(short)
                    short = []
                    yield from self._chunk_blocks(raw)
            yield b"".join(short)


class Decoder:
    """Token ids to text, token by token: a separator state, and the bytes of a character that is not yet complete.

    Without a decoder in the file, tokens are their vocabulary strings joined by a blank; with a byte-level one, the bytes they
    stand for (bytes that are no UTF-8 become U+FFFD)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec["decoder"] or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind} is not supported")
        code = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
        surface = (lambda t: t.encode()) if kind is None else (lambda t: b"".join(code.get(c, c.encode()) for c in t))
        tokens = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.table[i] = surface(token)
        self.between = b" " if kind is None else b""
        self.reset()

    def reset(self) -> None:
        self.first, self.state = True, codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, ids: list[int]) -> str:
        if not ids:
            return ""
        raw = self.between.join(map(self.table.__getitem__, ids))
        if not self.first:
            raw = self.between + raw
        self.first = False
        return self.state.decode(raw)

    def finish(self) -> str:
        rest = self.state.decode(b"", True)
        self.reset()
        return rest


_machines: dict[str, tuple[Encoder, Decoder]] = {}


def _machine(path: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder per Python worker and file."""
    if path not in _machines:
        _machines[path] = Encoder(path), Decoder(path)
    return _machines[path]


def _mapped(rows: DataFrame, schema: str, row) -> DataFrame:
    """(id, ...) from (id, value): ``row(bytes)`` gives the other columns; few rows per batch, so long ones do not add up."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, at, size = [], 0, 0
            values = batch.column("value").cast(pa.binary())
            for i in range(batch.num_rows):
                kept.append(row(values[i].as_py()))
                size += sum(len(x) for x in kept[-1] if isinstance(x, (bytes, str)))
                if size > 8 << 20 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_pydict({"id": batch.column("id")[at:i + 1],
                                                      **dict(zip(names, zip(*kept)))})
                    kept, at, size = [], i + 1, 0

    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, {schema}")


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids) per row: ids as binary, little-endian unsigned 32-bit. Null and empty texts have no tokens.

    ``tokenizer`` is a file found on every executor. Repeated rows and null ids stay as they are; an empty table gives no rows."""
    def row(raw: bytes):
        ids = b"".join(_machine(tokenizer)[0].blocks(raw))
        return len(ids) // 4, ids

    return _mapped(docs.select(F.col(id_column).alias("id"), text_of(text).alias("value")), "n_tokens long, ids binary", row)


def decode(tokens: DataFrame, tokenizer: str, id_column: str = "id", ids: str = "ids") -> DataFrame:
    """(id, text) per row of binary ids. Null ids are an empty text."""
    def row(raw: bytes):
        machine = _machine(tokenizer)[1]
        found = np.frombuffer(raw, "<u4")
        return ("".join([*(machine.push(found[at:at + BLOCK].tolist()) for at in range(0, len(found), BLOCK)), machine.finish()]),)

    return _mapped(tokens.select(F.col(id_column).alias("id"), F.coalesce(F.col(ids), F.lit(b"")).alias("value")), "text string", row)


def digests(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): every text encoded and decoded again, block by block.

    Digests are lowercase hex: of the ids as in ``encode``, and of the decoded text in UTF-8. Nulls as in ``encode``."""
    def row(raw: bytes):
        encoder, decoder = _machine(tokenizer)
        n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
        for block in encoder.blocks(raw):
            n += len(block) // 4
            of_ids.update(block)
            of_text.update(decoder.push(np.frombuffer(block, "<u4").tolist()).encode())
        of_text.update(decoder.finish().encode())
        return n, of_ids.hexdigest(), of_text.hexdigest()

    return _mapped(docs.select(F.col(id_column).alias("id"), text_of(text).alias("value")),
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
