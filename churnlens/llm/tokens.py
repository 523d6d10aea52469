"""Edit-aware token counts on segment trees of pre-token runs (operator 10)."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF_CHARS = 256
#: Pre-token pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A place where every pre-tokenisation breaks whatever stands around: text, one blank, a letter.
_CUT = re.compile(r"(?<=\S)(?= [^\W\d_])")


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def cut(text: str) -> list[int]:
    """Ends of the leaves: safe places at least LEAF_CHARS apart, and the text's end."""
    ends, at = [], 0
    while at + LEAF_CHARS < len(text):
        m = _CUT.search(text, at + LEAF_CHARS)
        if m is None or m.start() >= len(text):
            break
        at = m.start()
        ends.append(at)
    if len(text) > at:
        ends.append(len(text))
    return ends


class TokenTree:
    """Token counts of a text: leaves of whole pre-tokens under a binary tree of sums."""

    def __init__(self, text: str, count):
        self.count = count
        self.encoded_chars = 0
        self._build(self._pieces(text))

    def _pieces(self, text: str) -> list[tuple[str, int]]:
        ends = cut(text)
        pieces = [text[a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905
        self.encoded_chars += len(text)
        return list(zip(pieces, self.count(pieces), strict=True))

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.texts = [t for t, _ in leaves]
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in self.texts])]).astype(np.int64)
        self.base = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = np.zeros(2 * self.base, np.int64)
        self.sums[self.base:self.base + len(leaves)] = [n for _, n in leaves]
        for lo in (self.base >> k for k in range(1, self.base.bit_length())):
            self.sums[lo:2 * lo] = self.sums[2 * lo:4 * lo:2] + self.sums[2 * lo + 1:4 * lo:2]

    @property
    def total(self) -> int:
        return int(self.sums[1])

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def edit(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of characters ``start`` to ``end``.

        Only the leaves that the edit touches and one on either side, whose
        outer ends are places that no change inside can move, are encoded.
        """
        size = int(self.starts[-1])
        start, end = max(0, min(start, size)), max(0, min(end, size))
        end = max(start, end)
        n = len(self.texts)
        if not n:
            self._build(self._pieces(new))
            return
        a = max(0, int(np.searchsorted(self.starts, start, "right")) - 2)
        b = min(n, int(np.searchsorted(self.starts, end, "left")) + 1)
        lo = int(self.starts[a])
        old = "".join(self.texts[a:b])
        region = self._pieces(old[:start - lo] + new + old[end - lo:])
        if len(region) == b - a:  # the tree keeps its shape: leaves and their ancestors change
            self.texts[a:b] = [t for t, _ in region]
            self.starts[a + 1:] = lo + np.cumsum([len(t) for t in self.texts[a:]])
            for i, (_, c) in zip(range(a, b), region, strict=True):
                k = self.base + i
                delta = c - self.sums[k]
                while k and delta:
                    self.sums[k] += delta
                    k >>= 1
            return
        counts = self.sums[self.base:self.base + n].tolist()
        self._build([*zip(self.texts[:a], counts[:a], strict=True), *region,
                     *zip(self.texts[b:], counts[b:], strict=True)])


def _counter(path: str):
    enc = encoder(path)

    def count(pieces: list[str]) -> list[int]:
        return [len(enc.encode_ordinary(p)) for p in pieces]
    return count


def default_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with ``edits``, the changes that the query applies to every document.

    In order: the word run at two thirds is cut out (ten characters), a sentence
    goes in at the middle, and the first character is replaced. Positions are
    code points of the text as it is when the edit comes.
    """
    n = F.length(F.coalesce("text", F.lit("")))
    one = lambda a, b, t: F.struct(F.floor(a).cast("int").alias("start"), F.floor(b).cast("int").alias("stop"),
                                   F.lit(t).alias("new"))
    return docs.withColumn("edits", F.array(one(n * 2 / 3, n * 2 / 3 + 10, ""),
                                            one(n / 2, n / 2, " This sentence was put in later."),
                                            one(F.lit(0), F.lit(1), "# ")))


def count_with_edits(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_tokens_after, n_leaves, n_chars_after, n_encoded`` per document.

    ``docs`` may bring ``edits`` (an array of ``start, stop, new``, applied in
    order); without that column ``default_edits`` holds. ``n_encoded`` is the
    number of characters encoded again for the edits. Null texts are empty and
    null edits none; positions beyond the text mean its end; repeated rows and
    null ids are passed through; other columns are ignored. The vocabulary file
    must lie at the same path on every executor.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       *(["edits"] if "edits" in docs.columns else []))
    rows = rows if "edits" in rows.columns else default_edits(rows)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(vocabulary)
        for f in frames:
            out = []
            for doc_id, text, edits in zip(f["doc_id"], f["text"], f["edits"], strict=True):
                tree = TokenTree(text if isinstance(text, str) else "", count)
                before, first = tree.total, tree.encoded_chars
                leaves = len(tree.texts)
                for e in edits if edits is not None else []:
                    tree.edit(int(e["start"]), int(e["stop"]), e["new"] or "")
                out.append((doc_id, before, tree.total, leaves, int(tree.starts[-1]), tree.encoded_chars - first))
            got = pd.DataFrame(out, columns=["doc_id", "n_tokens", "n_tokens_after", "n_leaves", "n_chars_after",
                                             "n_encoded"])
            yield got.assign(doc_id=got["doc_id"].astype("Int64"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, n_tokens_after long, n_leaves long, "
                                 "n_chars_after long, n_encoded long")
