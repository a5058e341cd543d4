"""BPE encoding and decoding with a tokenization automaton (operator 4).

The automaton's arcs are labelled with tokens, and its paths are exactly the
sequences that the merges produce. It starts as one state with a loop for
every base symbol. The merges are compiled in rank order, each by one gadget
for ``a b -> c``:

* wherever an arc ``a`` leads to a state that has an arc ``b``, a new arc
  ``c`` leads past both, to where ``b`` led;
* the arcs ``a`` are redirected to a copy of their state without the arc
  ``b`` (and so without any later token that begins with it).

All arcs of one label lead to the same state, and a state is its parent less
one arc, so a gadget takes constant space: ``target[c]`` starts as a copy of
``target[b]``, and ``target[a]`` gets one more cut. ``cut[a, b]`` tells which
gadget made the cut; a token is cut too if it was built later upon a cut one.

The automaton is deterministic in this sense: for every prefix of a word
there is one accepted path, so encoding follows table entries (pieces by their
bytes, arcs by state and token), the longest piece first, and a place from
which it had to turn back is not entered again.
Decoding emits the arc labels.

The file's normaliser (NFC, white space, lower case), its splitting pattern,
its special tokens and its decoder (none: labels joined by a space) are those
of the tokenizers library for this kind of vocabulary.

Defined cases: a null or empty text has no ids and decodes to the empty text;
a special token's string in a text is that token; other columns pass through.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Distinct words, and distinct strings between white space, whose ids a worker keeps; beyond that it starts anew.
CACHED_WORDS = 150_000
#: Longer words and strings are not kept.
CACHED_LENGTH = 64
#: Rows of one Arrow batch that leave a task.
SLICE = 64
_ANY = 1 << 60


def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte: itself where it is printable, else 256, 257, ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Automaton:
    """Compiled merges: ``encode_word`` and ``labels``."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.labels = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.labels[i] = token
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token, i in vocab.items():
            end = bool(suffix) and token.endswith(suffix) and token != suffix
            body = token[: -len(suffix)] if end else token
            (self.final if end else self.inner)["".join(chr(byte_of[c]) for c in body)] = i
        if not suffix:
            self.final = self.inner
        # what a token begins with, and its id if it is a token inside a word (else -1)
        self.begins = dict.fromkeys((piece[:k] for piece in (*self.inner, *self.final) for k in range(1, len(piece) + 1)), -1) | self.inner
        size = len(self.labels)
        # behind arc t lies a state with t's own cuts and, up to the gadget that made t, those behind its second half;
        # first[t]: the half that t begins with, and the gadget that made t
        self.target: list[tuple[int, int]] = [(-1, 0)] * size
        self.first: list[tuple[int, int]] = [(-1, 0)] * size
        self.cut: dict[int, int] = {}
        for rank, (x, y) in enumerate(merges):
            a, b, c = vocab[x], vocab[y], vocab[x + y]
            self.target[c] = (b, rank)  # behind c: what was behind b until now
            self.first[c] = (a, rank)
            self.cut.setdefault(a * size + b, rank)
        self.size, self.arcs = size, {}

    def arc(self, last: int, token: int) -> bool:
        """Is there an arc ``token`` in the state behind ``last``? Found once, then looked up in ``arcs``."""
        if len(self.arcs) >= 2 * CACHED_WORDS:
            self.arcs.clear()
        known = self.arcs[last * self.size + token] = self._walk(last, token)
        return known

    def _walk(self, last: int, token: int) -> bool:
        before_y = _ANY
        while last >= 0:
            z, before_z = token, _ANY
            while z >= 0:
                made = self.cut.get(last * self.size + z)
                if made is not None and made < before_y and made <= before_z:
                    return False
                z, before_z = self.first[z]
            last, before_y = self.target[last]
        return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word, given as its bytes (one character each)."""
        n, begins, arcs, size = len(word), self.begins.get, self.arcs.get, self.size
        path, left, starts, dead, j, last = [], [], [], set(), 0, -1
        while True:
            options = []  # the tokens that begin here, the longest last
            for i in range(j + 1, n):
                token = begins(word[j:i])
                if token is None:
                    break
                if token >= 0:
                    options.append((i, token))
            else:
                token = self.final.get(word[j:])
                if token is not None:
                    options.append((n, token))
            while True:
                if not options:  # no other path leads to this place
                    if not path:
                        raise ValueError("the vocabulary lacks a base symbol")
                    dead.add(j)
                    path.pop()
                    options, j, last = left.pop(), starts.pop(), path[-1] if path else -1
                    continue
                i, token = options.pop()
                if i in dead:
                    continue
                if last < 0:
                    break
                arc = arcs(last * size + token)
                if arc or arc is None and self.arc(last, token):
                    break
            path.append(token)
            if i == n:
                return path
            left.append(options)
            starts.append(j)
            j, last = i, token


# Characters that Unicode 16 and 17 added, which Python's tables (15.1) lack.
_ADDED = {
    "L": r"\u1c89-\u1c8a\ua7cb-\ua7cd\ua7da-\ua7dc\U000105c0-\U000105f3\U00010d4a-\U00010d65\U00010d6f-\U00010d85"
         r"\U00010ec2-\U00010ec4\U00011380-\U00011389\U0001138b\U0001138e\U00011390-\U000113b5\U000113b7\U000113d1\U000113d3"
         r"\U00011bc0-\U00011be0\U00013460-\U000143fa\U00016100-\U0001611d\U00016d40-\U00016d6c\U00018cff"
         r"\U0001e5d0-\U0001e5ed\U0001e5f0",
    "N": r"\U00010d40-\U00010d49\U000116d0-\U000116e3\U00011bf0-\U00011bf9\U00016130-\U00016139\U00016d70-\U00016d79"
         r"\U0001ccf0-\U0001ccf9\U0001e5f1-\U0001e5fa",
}
_LOWERED = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
_LOWERED |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_NEW_UPPER = re.compile("[" + "".join(map(chr, _LOWERED)) + "]")


def lower(text: str) -> str:
    """Lower case character by character (a final sigma is like any other)."""
    if text.isascii():
        return text.lower()
    if _NEW_UPPER.search(text):
        text = text.translate(_LOWERED)
    return text.replace("Σ", "σ").lower()


def _class(kind: str) -> str:
    """The ranges of all characters of a Unicode category, as the inside of a character class."""
    has = np.array([c[0] == kind for c in map(unicodedata.category, map(chr, range(0x110000)))])
    edges = np.flatnonzero(np.diff(has, prepend=False, append=False))
    return "".join(rf"\U{x:08x}-\U{y - 1:08x}" for x, y in edges.reshape(-1, 2).tolist()) + _ADDED[kind]


#: White space of Unicode, as a pattern's \s has it.
SPACES = r"\x09-\x0d\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: What ``str.split`` takes for white space beside those.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Recent(dict):
    """``found`` of the strings asked for last; when it is full, those asked for before it was last full go."""

    def __init__(self, found: Callable[[str], bytes]):
        super().__init__()
        self.found, self.before = found, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.found(key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS // 2:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class Tokenizer:
    """Text to ids and back. Call ``ready`` first."""

    def __init__(self, spec: str):
        file = json.loads(spec)
        model = file["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        kinds = [n["type"] for n in file["normalizer"]["normalizers"]]
        split = file["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or file["decoder"] or not split["invert"] or model["type"] != "BPE":
            raise ValueError("only word vocabularies with NFC, lower case, a splitting pattern and no decoder are known")
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.labels = self.automaton.labels + [""] * (max(self.special.values(), default=-1) + 1 - len(self.automaton.labels))
        for text, i in self.special.items():
            self.labels[i] = text
        classes = ((r"[\p{L}]", f"[{_class('L')}]"), (r"[\p{N}]", f"[{_class('N')}]"),
                   (r"[^\s\p{L}\p{N}]", f"[^{SPACES}{_class('L')}{_class('N')}]"))
        self.pattern = split["pattern"]["Regex"]
        for short, full in classes:
            self.pattern = self.pattern.replace(short, full)
        if r"\p" in self.pattern or r"\s" in self.pattern:
            raise ValueError("the splitting pattern has a class that is not known")


    def ready(self) -> Tokenizer:
        """Compiles the patterns."""
        self.find = re.compile(self.pattern).findall
        # characters of 16 bits are looked up in one table, others in a list of ranges
        self.find_basic = re.compile(re.sub(r"\\U000[1-9a-f][0-9a-f]{4}(-\\U000[1-9a-f][0-9a-f]{4})?", "", self.pattern)).findall
        self.beyond_basic = re.compile("[\U00010000-\U0010ffff]").search
        marks = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(marks) + ")").split if marks else lambda text: [text]
        self.label_array = pa.array(self.labels, pa.string())
        self.words, self.chunks = Recent(self.word), Recent(self.pieces)
        return self

    def word(self, word: str) -> bytes:
        """The ids of a word, as int32 bytes."""
        return array("i", self.automaton.encode_word(word.encode().decode("latin-1"))).tobytes()

    def pieces(self, text: str) -> bytes:
        """The ids of a text without special tokens, as int32 bytes."""
        text = lower(unicodedata.normalize("NFC", text))
        find = self.find_basic if text.isascii() or not self.beyond_basic(text) else self.find
        return b"".join(map(self.words.__getitem__, find(text)))

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a whole text.

        No word holds white space, and neither NFC nor lower case reaches
        across it, so a text is encoded string by string between white space.
        """
        text, chunks, out = text or "", self.chunks, []
        for k, part in enumerate(self.parts(text) if any(mark in text for mark in self.special) else [text]):
            if k % 2:
                out.append(np.array([self.special[part]], np.int32).tobytes())
            elif any(c in part for c in SEPARATORS):
                out.append(self.pieces(part))
            else:
                out.extend(map(chunks.__getitem__, part.split()))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        """The labels of the ids, joined by a space (the vocabulary has no decoder)."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """``decode`` of every list of ids, none of them null or a slice of others."""
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.label_array.take(ids.values)), " ")


def _columns(batch: pa.RecordBatch, names: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), *more.values()], [*names, *more])


def _ids_array(rows: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32()))


def encode(docs: DataFrame, path: str, columns: list[str], text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``columns`` of every document and its ids; with ``decoded``, also what they decode to.

    The vocabulary file is read on the driver and broadcast (a few MB, fixed
    by the file); each worker process compiles it once, so the driver holds
    its text only.
    """
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(shared, "tokenizer"):  # once in a worker process, whose next tasks find the words met so far
            shared.tokenizer = Tokenizer(shared.value).ready()
        tokenizer = shared.tokenizer
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                rows = [tokenizer.encode(t) for t in part.column(len(columns)).to_pylist()]
                more = {out: _ids_array(rows)}
                if decoded:
                    more[decoded] = tokenizer.decode_all(more[out])
                yield _columns(part, columns, more)

    schema = docs.select(*columns).schema.add(out, ArrayType(IntegerType()))
    if decoded:
        schema = schema.add(decoded, "string")
    return docs.select(*columns, F.col(text).alias("__text")).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, columns: list[str], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``columns`` of every row and the text that its ``ids`` decode to (null ids: the empty text)."""
    with open(path, encoding="utf-8") as file:
        labels = rows.sparkSession.sparkContext.broadcast(Tokenizer(file.read()).labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = labels.value
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                texts = [" ".join([table[i] for i in x or ()]) for x in part.column(len(columns)).to_pylist()]
                yield _columns(part, columns, {out: pa.array(texts, pa.string())})

    return rows.select(*columns, F.col(ids).alias("__ids")).mapInArrow(run, rows.select(*columns).schema.add(out, "string"))
