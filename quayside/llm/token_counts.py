"""Token counts with a whole-token shortcut.

A vocabulary string *encodes alone* when the merge table turns the pre-token spelled like it into that one token. Which
strings do is proved once, on the driver, by running every vocabulary string through the merges. A pre-token that is in
this set counts one without any merging; only the rest go through the merge table.

Texts are split at ASCII white space first: the normaliser and the pre-tokeniser never look across it, so the count of a
text is the sum over its white-space-free chunks, and chunks that recur are counted once per worker.

Null text counts as empty (0 bytes, 0 tokens); a null id stays null; repeated rows give repeated results; an empty table
gives an empty table; further columns of the input are ignored. A very long text is counted whole, chunk by chunk; only a
chunk without any white space is held (and merged) at once, and long chunks aren't remembered. There are no ties.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick, utf8

#: Fixed values of the vocabulary file: its normaliser and pre-tokeniser, on which the splitting at white space rests.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern for lower-case printable ASCII, whose characters the byte-level alphabet spells as themselves.
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
PRINTABLE = bytes(range(33, 127))


@functools.lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=4)
def checked(path: str) -> str:
    """The path, if its file splits and normalises as this module takes for granted."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    split, spelled = (said["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])[:2]
    known = said["normalizer"] == NORMALIZER and split.get("pattern") == {"Regex": PIECES} and split.get("invert") and split.get("behavior") == "Removed"
    if not known or spelled.get("type") != "ByteLevel" or spelled.get("use_regex") or spelled.get("add_prefix_space"):
        raise ValueError(f"{path} doesn't split texts at white space in the known way")
    return path


def whole_tokens(path: str) -> frozenset[str]:
    """The pre-tokens that the merges turn into one token, out of all vocabulary strings that end a word.

    Bounded by the size of the vocabulary, whatever the corpus.
    """
    tok = _tokenizer(path)
    suffix = tok.model.end_of_word_suffix or ""
    proved = set()
    for string, token_id in tok.get_vocab(with_added_tokens=False).items():
        if string.endswith(suffix) and (piece := string[: len(string) - len(suffix)]):
            made = tok.model.tokenize(piece)
            if len(made) == 1 and made[0].id == token_id:
                proved.add(piece)
    return frozenset(proved)


class ChunkCounts(dict):
    """Tokens of a chunk without white space; chunks of up to `longest` bytes are kept until there are `most` of them."""

    def __init__(self, path: str, whole: frozenset[str], most: int = 400_000, longest: int = 64):
        super().__init__()
        self.tok, self.whole, self.most, self.longest = _tokenizer(path), whole, most, longest

    def pieces(self, chunk: bytes) -> list[str]:
        if not chunk.translate(None, PRINTABLE):
            return ASCII_PIECES.findall(chunk.decode().lower())
        text = self.tok.normalizer.normalize_str(chunk.decode())
        return [piece for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def __missing__(self, chunk: bytes) -> int:
        tokens = 0
        for piece in self.pieces(chunk):
            tokens += 1 if piece in self.whole else len(self.tok.model.tokenize(piece))
        if len(chunk) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[chunk] = tokens
        return tokens


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` of every text; special strings in a text count as their one token."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col)
    whole = spark.sparkContext.broadcast(whole_tokens(checked(tokenizer_path)))
    added = [t.content.encode() for t in _tokenizer(tokenizer_path).get_added_tokens_decoder().values()]
    special = re.compile(b"|".join(map(re.escape, sorted(added, key=len, reverse=True))) or rb"(?!)")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = ChunkCounts(tokenizer_path, whole.value)
        for batch in batches:
            sizes, tokens = [], []
            for text in utf8(batch, "text"):
                specials = len(special.findall(text)) if any(a in text for a in added) else 0
                parts = special.split(text) if specials else (text,)
                sizes.append(len(text))
                tokens.append(specials + sum(counts[chunk] for part in parts for chunk in part.split()))
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), n, pa.array([t > limit for t in tokens], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(counted, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long, over_limit boolean")
