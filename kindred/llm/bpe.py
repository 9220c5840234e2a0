"""BPE encoding and decoding as streaming transducers with bounded memory.

Encoding reads a text in chunks.  White space, special tokens and the pre-token classes cut it
into pieces; inside a piece, merges are applied to a buffer, and a token leaves the buffer once
no further input can change it.  How far a token boundary can depend on what follows is
computed from the merge list (``lookahead``), so the buffer never holds more than that bound,
one chunk and one token, however long the piece is.

Decoding turns ids into bytes and bytes into text with an incremental UTF-8 machine that keeps
at most three bytes.

The reader takes tokenizer files of the public ``tokenizers`` JSON layout whose model is BPE over
byte symbols with an end-of-word suffix, normalised by NFC, white space and lower case.

Null texts count as empty; an empty text has no tokens.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import tidy

CHUNK = 1 << 12  # symbols of one piece that the encoder takes in at once
TEXT_CHUNK = 1 << 16  # characters of a text that are normalised at once
CACHED = 1 << 16  # entries of each half of a Python worker's two memories, some 20 MB a half (pieces: twice that)
LONGEST_CACHED = 64
_SPACE = regex.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols after a token boundary that can decide whether it stays.

    Merge k joins u|v over a boundary if v's last symbol ends a token by then, which only an
    earlier merge that takes a suffix of v as its left part can prevent.  So the reach of merge
    k is |v| plus the longest reach of earlier merges whose left part is a suffix of v.
    """
    reach_of_left: dict[str, int] = {}
    longest = 0
    for left, right in merges:
        beyond = 0
        for i in range(len(right)):
            beyond = max(beyond, reach_of_left.get(right[i:], 0))
        reach = len(right) + beyond
        longest = max(longest, reach)
        if reach > reach_of_left.get(left, 0):
            reach_of_left[left] = reach
    return longest


class Model:
    """Vocabulary, merge ranks and text rules of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        mark = lambda t: t[: -len(self.suffix)] + "\0" if self.suffix and t.endswith(self.suffix) and len(t) > len(self.suffix) else t
        # the last symbol of a word, with its suffix, is one symbol
        symbols = lambda t: mark(t)[:-2] + chr(0x10000 + ord(mark(t)[-2])) if mark(t).endswith("\0") else t
        self.reach = lookahead([(symbols(a), symbols(b)) for a, b in merges])
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.names = {i: str(i) for i in self.tokens}
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self.symbols = byte_symbols()
        self.bytes = {s: b for b, s in enumerate(self.symbols)}
        self.table = {b: s for b, s in enumerate(self.symbols)}
        self.token_bytes = {i: t.encode() for i, t in self.tokens.items()}
        self.readable_bytes = {i: self._readable(t) for i, t in self.tokens.items()}

    def _readable(self, token: str) -> bytes:
        if token in self.special:
            return token.encode()
        end = bool(self.suffix) and token.endswith(self.suffix)
        body = token[: len(token) - len(self.suffix)] if end else token
        return bytes(map(self.bytes.__getitem__, body)) + b" " * end

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # lower case goes by single characters, so a final sigma is an ordinary one
        return text.replace("Σ", "σ").lower()

    def spell(self, piece: str) -> str:
        """The piece's bytes as symbols."""
        if piece.isascii() and piece.isprintable():
            return piece
        return piece.encode().decode("latin-1").translate(self.table)


class PieceEncoder:
    """Incremental merges over one piece: ``feed`` symbols, then ``close``.

    Emitted tokens are final: a boundary followed by at least ``reach`` symbols can't change,
    and what stands left of a lasting boundary does not bear on what stands right of it.
    """

    def __init__(self, model: Model):
        self.model = model
        self.buffer = ""

    def feed(self, symbols: str) -> list[str]:
        self.buffer = self.buffer + symbols if self.buffer else symbols
        # the newest symbol may be the word's last and is held back
        stable = len(self.buffer) - 1 - self.model.reach
        if stable < CHUNK:
            return []
        tokens = merge(list(self.buffer), self.model.ranks)
        out, at = [], 0
        for token in tokens:
            if at + len(token) > stable:
                break
            out.append(token)
            at += len(token)
        self.buffer = self.buffer[at:]
        return out

    def close(self) -> list[str]:
        if not self.buffer:
            return []
        symbols = list(self.buffer)
        symbols[-1] += self.model.suffix
        self.buffer = ""
        return merge(symbols, self.model.ranks)


def merge(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merge of least rank, the leftmost of equals, until none is left."""
    if len(symbols) > 64:
        return _merge_long(symbols, ranks)
    none = len(ranks)
    rank_of = ranks.get
    found = [rank_of(p, none) for p in zip(symbols, symbols[1:])]
    while found:
        best = min(found)
        if best == none:
            break
        i = found.index(best)
        symbols[i] += symbols.pop(i + 1)
        del found[i]
        if i:
            found[i - 1] = rank_of((symbols[i - 1], symbols[i]), none)
        if i < len(found):
            found[i] = rank_of((symbols[i], symbols[i + 1]), none)
    return symbols


def _merge_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same with a heap over a linked list, for pieces of many symbols."""
    import heapq

    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(ranks[p], i, p) for i in range(n - 1) if (p := (symbols[i], symbols[i + 1])) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        if not alive[i] or symbols[i] != pair[0]:
            continue
        j = after[i]
        if j >= n or symbols[j] != pair[1]:
            continue
        symbols[i] = pair[0] + pair[1]
        alive[j] = False
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (p := (symbols[a], symbols[b])) in ranks:
                heapq.heappush(heap, (ranks[p], a, p))
    return [s for s, ok in zip(symbols, alive) if ok]


class Encoder:
    """Text in, ids out, chunk by chunk; what is held does not grow with the text.

    White space never lies inside a piece, so a text is cut there, and the tokens of a stretch
    between white space are made once and remembered while there is room.
    """

    def __init__(self, model: Model):
        self.model = model
        self.decoder = Decoder(model)
        # the newer and the older half of what is remembered, of stretches and of pieces
        self.known: dict[str, tuple[str, int, str]] = {}
        self.before: dict[str, tuple[str, int, str]] = {}
        self.pieces: dict[str, tuple[str, int, str]] = {}
        self.pieces_before: dict[str, tuple[str, int, str]] = {}

    def forget(self) -> None:
        """Give the memory back; workers live on after a task and serve other stages."""
        self.known, self.before, self.pieces, self.pieces_before = {}, {}, {}, {}

    def _made(self, piece: str) -> tuple[str, int, str]:
        """Joined ids, their number and the joined decoded tokens of a piece."""
        found = self.pieces_before.get(piece)
        if found is None:
            symbols = self.model.spell(piece)
            encoder = PieceEncoder(self.model)
            tokens: list[str] = []
            for i in range(0, len(symbols), CHUNK):
                tokens += encoder.feed(symbols[i : i + CHUNK])
            tokens += encoder.close()
            ids = [self.model.vocab[t] for t in tokens]
            found = (" ".join([self.model.names[i] for i in ids]), len(ids), self.decoder.text(ids))
        if len(piece) <= LONGEST_CACHED:
            if len(self.pieces) >= 2 * CACHED:
                self.pieces, self.pieces_before = {}, self.pieces
            self.pieces[piece] = found
        return found

    def look_up(self, stretch: str) -> tuple[str, int, str]:
        """The same for a stretch without white space or special tokens."""
        found = self.before.get(stretch)
        if found is None:
            known, made = self.pieces.get, self._made
            parts = [known(p) or made(p) for p in self.model.pieces.findall(self.model.normalise(stretch))]
            if len(parts) == 1:
                found = parts[0]
            else:
                ids, n, tokens = zip(*parts) if parts else ((), (), ())
                found = (" ".join(ids), sum(n), " ".join(tokens))
        if len(stretch) <= LONGEST_CACHED:
            if len(self.known) >= CACHED:
                self.known, self.before = {}, self.known
            self.known[stretch] = found
        return found

    def chunks(self, text: str):
        """Lists of (joined ids, number, joined tokens), each for a bounded part of the text."""
        special = self.model.special_pattern
        at = 0
        if any(s in text for s in self.model.special):
            for hit in special.finditer(text):
                yield from self._plain(text, at, hit.start())
                token = self.model.special[hit.group()]
                yield [(str(token), 1, Decoder(self.model).text([token]))]
                at = hit.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int):
        look_up = self.look_up
        while at < end:
            known = self.known.get
            cut = end
            if end - at > TEXT_CHUNK and (space := _SPACE.search(text, at + TEXT_CHUNK, end)):
                cut = space.start()
            yield [known(w) or look_up(w) for w in _stretches(text[at:cut])]
            at = cut


def _stretches(text: str) -> list[str]:
    """What stands between white space.

    str.split also cuts at the four information separators, which are none; texts that hold one
    go through a pattern.
    """
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


class Decoder:
    """Ids to text: the tokens' bytes go through an incremental UTF-8 machine.

    ``feed`` returns what is certain by now; an unfinished character of at most three bytes
    waits for the next call.  A file that names no decoder has its tokens joined by a space;
    with ``readable``, symbols become the bytes they stand for and word ends a space.
    """

    def __init__(self, model: Model, readable: bool = False):
        self.model, self.readable, self.fresh = model, readable, True
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        known = self.model.readable_bytes if self.readable else self.model.token_bytes
        data = (b"" if self.readable else b" ").join([known.get(i, b"") for i in ids])
        if not self.readable and data:
            data, self.fresh = (data if self.fresh else b" " + data), False
        return self.machine.decode(data)

    def close(self) -> str:
        return self.machine.decode(b"", True)

    def text(self, ids) -> str:
        """A whole sequence; the machine is ready for the next one afterwards."""
        self.fresh = True
        return self.feed(ids) + self.close()


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(Model(path))


def _rows(path: str):
    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            out = []
            for text in batch.column("text"):
                n, ids, decoded, fresh = 0, hashlib.sha256(), hashlib.sha256(), True
                for part in encoder.chunks(text.as_py() or ""):
                    part = [x for x in part if x[1]]
                    if part:
                        a, b, c = zip(*part)
                        gap = "" if fresh else " "
                        ids.update((gap + " ".join(a)).encode())
                        decoded.update((gap + " ".join(c)).encode())
                        n += sum(b)
                        fresh = False
                out.append((n, ids.hexdigest(), decoded.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (pa.int64(), pa.string(), pa.string())))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        encoder.forget()

    return run


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the text decoded from them.

    ``path`` is the tokenizer file, which every node must be able to read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidy(_rows(path)), OUT)


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id and its token ids."""

    def run(batches):
        encoder = _encoder(path)
        for batch in batches:
            ids = [[int(i) for part in encoder.chunks(t.as_py() or "") for x in part for i in x[0].split()] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<long>")
