"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token exactly one token ends its BPE encoding. Going left to
right, an automaton over the vocabulary (a trie with suffix links) names the tokens that
end at each place, longest first; the right one is that which may follow the last token
of the prefix before it. Two tokens may stand side by side if undoing their merges, latest
first, never uncovers a pair that BPE would have merged earlier across the seam. The
last token of each prefix is stored; following the stored tokens back from the end
gives the ids. They equal those of merging by rank, without a merge loop.

Vocabulary and merges are read from a tokenizer file whose path is a parameter; the
library's pre-tokenizer cuts texts, its encoder is not used.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtide.llm.blocks import byte_blocks, giving_back
from logtide.llm.bpe_pieces import Cutter, byte_characters, packed, pre_tokens
from logtide.llm.common import with_python

#: Bounds of a worker's dictionaries; a full one starts anew.
MOST_PAIRS, MOST_WORDS = 300_000, 50_000
#: Bytes of text encoded at once, and rows decoded at once.
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 256


class PrefixBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(pairs)}
        self.made: dict[int, int] = {}  # rank of the merge that makes a token
        self.halves: dict[int, tuple[int, int]] = {}
        for i, (a, b) in reversed(list(enumerate(pairs))):
            self.made[vocab[a + b]], self.halves[vocab[a + b]] = i, (vocab[a], vocab[b])
        self.pairs: dict[int, bool] = {}
        chars = {c: b for b, c in enumerate(byte_characters())}
        # Tokens that BPE can emit: single bytes, and tokens whose own text merges into them.
        self.whole: dict[str, int] = {}
        sound = {t for text, t in vocab.items() if text in chars}
        for text, t in sorted(vocab.items(), key=lambda x: self.made.get(x[1], -1)):
            half = self.halves.get(t)
            if half and half[0] in sound and half[1] in sound and self._stand(*half, self.made[t]):
                sound.add(t)
            if t in sound:
                self.whole[text] = t
        # Single bytes always match, so the automaton leaves them out.
        self.matches = ahocorasick.Automaton()
        for text, t in self.whole.items():
            if len(text) > 1:
                self.matches.add_word(text, (t, len(text)))
        self.matches.make_automaton()
        self.words: dict[str, list[int]] = {}

    def _stand(self, a: int, b: int, limit: int) -> bool:
        """Whether tokens ``a`` and ``b`` are still unmerged neighbours when the merge of rank ``limit`` comes.

        ``limit`` bounds the merges done so far. Undoing the latest merge of either side lowers
        it; a pair at the seam with a rank under it would have merged. Of equal ranks the one
        further left goes first, so the right side is undone first and its own rank still counts.
        """
        made = self.made
        while True:
            if self.rank.get((a, b), limit) < limit:
                return False
            ma, mb = made.get(a, -1), made.get(b, -1)
            if ma > mb:
                limit, a = ma, self.halves[a][1]
            elif mb >= 0:
                limit, b = mb + 1, self.halves[b][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._stand(left, right, len(self.rank))
        return known

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token, given in byte characters."""
        if word in self.whole:
            return [self.whole[word]]
        n, pairs = len(word), self.pairs.get
        # Where no longer token ends, the last one is the single byte.
        last, before, decided = [-1, *map(self.whole.__getitem__, word)], list(range(-1, n)), -1
        for end, (t, size) in self.matches.iter(word):  # ends ascend, longest first
            if end == decided:
                continue
            i = end + 1 - size
            if i:
                stand = pairs(last[i] << 32 | t)
                if stand is None:
                    stand = self.compatible(last[i], t)
                if not stand:
                    continue
            last[end + 1], before[end + 1], decided = t, i, end
        out, at = [], n
        while at:
            out.append(last[at])
            at = before[at]
        return out[::-1]

    def known_word(self, word: str) -> list[int]:
        """Ids of a pre-token that may come up again (marks, numbers)."""
        got = self.words.get(word)
        if got is None:
            got = self.encode_word(word)
            if len(word) <= 32:
                if len(self.words) >= MOST_WORDS:
                    self.words.clear()
                self.words[word] = got
        return got

    def encode_piece(self, pre_tokenize, text: str) -> bytes:
        """Packed ids of a piece of text."""
        two = pre_tokens(text)
        if two:
            word, marks = two
            return packed(self.encode_word(word) + self.known_word(marks) if marks else self.encode_word(word))
        ids: list[int] = []
        for word, _ in pre_tokenize(text):
            ids += self.known_word(word)
        return packed(ids)


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    chars = {c: b for b, c in enumerate(byte_characters())}
    of = {t: bytes(chars[c] for c in text) if all(c in chars for c in text) else text.encode()
          for text, t in spec["model"]["vocab"].items()}
    of |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [of.get(i, b"") for i in range(max(of) + 1)]


@lru_cache(maxsize=2)
def _decoder(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens, where each starts, its size)."""
    of = token_bytes(path)
    sizes = np.fromiter(map(len, of), np.int64, len(of))
    return np.frombuffer(b"".join(of), np.uint8), np.cumsum(sizes) - sizes, sizes


@lru_cache(maxsize=2)
def _coder(path: str) -> tuple[PrefixBpe, Cutter]:
    """One encoder for each tokenizer file and Python worker."""
    from tokenizers import Tokenizer

    bpe = PrefixBpe(path)
    cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    return bpe, Cutter(lambda pieces: [bpe.encode_piece(cut, x) for x in pieces], {x: packed([t]) for x, t in bpe.special.items()})


def _encode(path: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cutter = _coder(path)
        for whole in batches:
            for batch in byte_blocks(whole, text_col, BLOCK_BYTES):
                ids, bounds = cutter.encode(batch.column(text_col))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view(np.int32)))
                keep = [c for c in batch.schema.names if c != text_col]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), lists], [*keep, "ids"])

    return giving_back(run)


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, sizes = _decoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                lists = batch.column("ids")
                ids = lists.flatten().to_numpy(zero_copy_only=False)  # null lists have no ids
                many = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                size = sizes[ids]
                ends = np.append(0, np.cumsum(size))
                text = data[np.repeat(starts[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
                cuts = ends[np.append(0, np.cumsum(many))].tolist()
                texts = [text[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return giving_back(run)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: a map without a shuffle.

    A null or empty text has no ids; texts are encoded whole; repeated rows give repeated rows; null
    ids are carried along; special tokens in a text become their ids, as the library has
    it; an empty table gives no rows; further columns are not looked at.
    """
    with_python(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encode(path, "text"), "id long, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``, the text of their column ``ids``; bytes that are not UTF-8 become
    U+FFFD, null ids an empty text."""
    with_python(encoded.sparkSession)
    return encoded.mapInArrow(_decode(path), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
