"""BPE encoding and decoding by a tokenization automaton (operator 10).

The merges are compiled into a deterministic automaton over *tokens* whose paths are exactly the
token sequences that BPE can produce. It starts with one state that every base symbol loops on, and
one final state behind the symbols that end a word. Merge (u, v) is one gadget: the state behind u
is split, the copy loses its v arc, u arcs lead to the copy, and wherever u may stand an arc for uv
is added that leads to where v led. The state behind a token depends on the token alone, so the
transition table factors into a class of states, a class of arc labels and one bit for each pair;
a gadget splits at most one class on each side (a class with a single member is changed in place).

Every prefix of a word has exactly one accepted token path. Encoding follows the longest arc that the
state allows by table look-ups and steps back where the rest of the word has no arc; a position is left
for good once, so a word takes a number of look-ups in proportion to its length. Decoding emits the
labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from webloom.llm.storage import arrow_map

MEMO_WORDS = 600_000

# Fixed values of the byte-level alphabet: printable bytes stand for themselves, the others, in
# ascending order, for the code points from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Texts made of these characters only are split by FAST (the tokenizer's own pattern
# with its classes written out for them); all others by the tokenizer's own normaliser and splitter.
_LETTERS = "a-zß-öø-ÿ"
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
FAST = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\t-\r {_LETTERS}0-9]+")


def byte_alphabet() -> list[str]:
    """The character for each byte value."""
    out = [""] * 256
    for b in _PRINTABLE:
        out[b] = chr(b)
    for k, b in enumerate(b for b in range(256) if not out[b]):
        out[b] = chr(256 + k)
    return out


class TokenAutomaton:
    """Deterministic automaton of one merge list. ``labels[t]`` is the string of token id t."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = ""):
        self.end, n = end, max(vocab.values(), default=-1) + 1
        self.labels = [""] * n
        for label, t in vocab.items():
            self.labels[t] = label
        made = {u + v for u, v in merges}
        base = [t for label, t in vocab.items() if label not in made]
        ends = lambda t: bool(end) and self.labels[t].endswith(end)
        # state class 0: start (never split); 1: behind a base symbol; 2: final. The table grows by a quarter when
        # a side is full; a merge adds at most one class to each side.
        allow = np.zeros((3 + len({u for u, _ in merges}), len({v for _, v in merges}) // 8 + 1), np.uint8)  # a bit for each pair
        allow[0:2, 0] = 3
        to, arc = [-1] * n, [-1] * n  # class behind a token; class of its arcs
        members_r, members_c = [0] * len(allow), [0] * (8 * allow.shape[1])
        for t in base:
            to[t], arc[t] = (2 if ends(t) else 1), (1 if ends(t) else 0)
            members_r[to[t]] += 1
            members_c[arc[t]] += 1
        rows, cols = 3, 2
        members_r[0] = members_r[2] = 1 << 30  # kept whole
        for a, b in merges:
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            r, c = to[u], arc[v]
            if r < 0 or c < 0 or not allow[r, c >> 3] >> (c & 7) & 1:
                continue  # the parts never meet
            behind, joins = to[v], arc[u]
            members_r[behind] += 1  # w is led to where v led, before u's own state is split
            if members_r[r] > 1:
                if rows == len(allow):
                    allow = np.pad(allow, ((0, rows // 4 + 8), (0, 0)))
                    members_r += [0] * (len(allow) - rows)
                allow[rows] = allow[r]
                members_r[r] -= 1
                to[u], members_r[rows], rows = rows, 1, rows + 1
            if u != v:
                members_c[joins] += 1  # w's arcs join u's class before v's class is split
            if members_c[c] > 1:
                if cols == 8 * allow.shape[1]:
                    allow = np.pad(allow, ((0, 0), (0, cols // 32 + 8)))
                    members_c += [0] * (8 * allow.shape[1] - cols)
                allow[:rows, cols >> 3] |= (allow[:rows, c >> 3] >> (c & 7) & 1) << (cols & 7)
                members_c[c] -= 1
                arc[v], members_c[cols], cols = cols, 1, cols + 1
            if u == v:
                joins = arc[u]  # [u, uu] is not a path, so w joins the class that lost the arc
                members_c[joins] += 1
            allow[to[u], arc[v] >> 3] &= 255 - (1 << (arc[v] & 7))
            to[w], arc[w] = behind, joins
        self.to, self.arc = to, arc
        self.rows = [x.tobytes() for x in allow[:rows, :(cols + 7) // 8]]
        self.ids = None  # the driver only builds and sends the table: workers index it when they first encode

    def _index(self) -> None:
        self.ids = {label: t for t, label in enumerate(self.labels) if label and self.arc[t] >= 0}
        # plain pieces only: the id of a token, or -1 for the beginning of longer ones
        self.trie = {}
        for label, t in self.ids.items():
            plain = not (self.end and label.endswith(self.end))
            for k in range(1, len(label) + plain):
                self.trie.setdefault(label[:k], -1)
            if plain:
                self.trie[label] = t

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("labels", "end", "to", "arc", "rows")}

    def __setstate__(self, got: dict) -> None:
        self.__dict__.update(got)
        self.ids = None

    def encode(self, symbols: str) -> list[int]:
        """Token ids of one pre-split word, given as base symbols; the end marker is added here."""
        if self.ids is None:
            self._index()
        end, ids, trie, arc, to, rows = self.end, self.ids, self.trie, self.arc, self.to, self.rows
        n, at, state = len(symbols), 0, 0
        path: list[tuple[int, int, list[tuple[int, int]]]] = []  # (position, state, shorter pieces not yet tried)
        dead: set[int] = set()
        out: list[int] = []
        while at < n:
            row, found = rows[state], []
            if end:
                t = ids.get(symbols[at:] + end)
                if t is not None and row[(c := arc[t]) >> 3] >> (c & 7) & 1:
                    out.append(t)
                    return out
            for j in range(at + 1, n + (not end)):
                t = trie.get(symbols[at:j])
                if t is None:
                    break
                if t >= 0:
                    found.append((j, t))
            while True:
                while found:
                    j, t = found.pop()
                    if j not in dead and row[(c := arc[t]) >> 3] >> (c & 7) & 1:
                        break
                else:  # no path from here to the end: a position has one path, so it need not be met again
                    dead.add(at)
                    if not path:
                        raise ValueError(f"no token path for {symbols!r}: a base symbol is missing in the vocabulary")
                    at, state, found = path.pop()
                    row = rows[state]
                    out.pop()
                    continue
                break
            path.append((at, state, found))
            out.append(t)
            at, state = j, to[t]
        return out


class WordBpe:
    """A tokenizer file of the word-end kind: splits texts, encodes by the automaton, decodes by labels."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], pairs, model.get("end_of_word_suffix") or "")
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.labels = list(self.automaton.labels)
        for label, t in self.added.items():
            self.labels += [""] * (t + 1 - len(self.labels))
            self.labels[t] = label
        self._path, self._bytes, self.memo, self._split = path, byte_alphabet(), {}, None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_split", "memo")}

    def __setstate__(self, got: dict) -> None:
        self.__dict__.update(got)
        self.memo, self._split = {}, None

    def words(self, text: str) -> list[str]:
        """Pre-split words of a text, normalised."""
        if PLAIN.fullmatch(text):
            return FAST.findall(text.lower())
        if self._split is None:
            from tokenizers import Tokenizer
            self._split = Tokenizer.from_file(self._path)
        # the splitter gives byte-level symbols; the same symbols are words of another alphabet here
        return [("\0" + w) for w, _ in self._split.pre_tokenizer.pre_tokenize_str(self._split.normalizer.normalize_str(text))]

    def _word(self, word: str) -> bytes:
        if word[0] == "\0":
            word = word[1:]
        elif not word.isascii():
            word = "".join([self._bytes[b] for b in word.encode()])
        return np.array(self.automaton.encode(word), "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        words, memo = self.words(text), self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        try:
            return b"".join([memo[w] for w in words])
        except KeyError:
            for w in set(words):
                if w not in memo:
                    memo[w] = self._word(w)
            return b"".join([memo[w] for w in words])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; added tokens are cut out first."""
        if self._cut is None or "<" not in text:
            return self._plain(text)
        out = []
        for k, part in enumerate(self._cut.split(text)):
            out.append(np.array([self.added[part]], "<u4").tobytes() if k % 2 else self._plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The labels of the ids with a space between them, as the tokenizer file has no decoder of its own."""
        labels = self.labels
        return " ".join([labels[t] for t in np.frombuffer(ids, "<u4").tolist()])


OUTPUTS = {
    "n_tokens": (T.LongType(), lambda ids, text: len(ids) // 4),
    "ids": (T.ArrayType(T.IntegerType(), False), lambda ids, text: np.frombuffer(ids, "<u4").astype(np.int32)),
    "decoded": (T.StringType(), lambda ids, text: text()),
    "ids_sha256": (T.StringType(), lambda ids, text: hashlib.sha256(ids).hexdigest()),
    "decoded_sha256": (T.StringType(), lambda ids, text: hashlib.sha256(text().encode()).hexdigest()),
}


def bpe_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                  outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """One row for each row of ``docs``: its id and the asked outputs of encoding its whole text.

    ``path`` is a tokenizer file with ``end_of_word_suffix``. The automaton is compiled once on the
    driver and broadcast: its size depends on the vocabulary alone. Words met are kept in a bounded
    memo in each worker. A null or empty text has no ids, an empty decoded text and the digests of
    empty input. Repeated rows and repeated ids each give their row; other columns are not read, so
    their names cannot clash. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(WordBpe(path))
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type)] + [T.StructField(o, OUTPUTS[o][0]) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                columns: list[list] = [[] for _ in outputs]
                for value in part.column(1):
                    ids = bpe.encode(value.as_py() or "")
                    kept: list[str] = []
                    text = lambda: (kept or kept.append(bpe.decode(ids)) or kept)[0]  # noqa: E731, B023
                    for out, name in zip(columns, outputs, strict=True):
                        out.append(OUTPUTS[name][1](ids, text))
                types = [pa.list_(pa.field("element", pa.int32(), False)) if o == "ids" else pa.int64() if o == "n_tokens" else pa.string() for o in outputs]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)

    return arrow_map(docs.select(id_col, text_col), run, schema)
