"""Token counts by the whole-token shortcut.

Offline, ``prove_whole_tokens`` asks the library which strings of the
vocabulary are one pre-token and encode, alone, as exactly one token.  Counting
then splits a text into pre-tokens: each proven one counts as one token
without merging, and only the others run the merges (each distinct one once,
kept in a bounded memo).  Nothing is shuffled: counts are row by row.

Null or empty text: 0 bytes, 0 tokens.  Repeated rows are counted like any
other.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are read,
so further columns, whatever their names, don't matter.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm.common import documents, map_rows, text_of
from tessera.llm.pretokens import byte_characters, classes, cut_added, library_split, needs_library, of_class
from tessera.llm.registry import register

#: Merged pre-tokens that a Python worker remembers before it starts afresh.
MEMO = 400_000


def prove_whole_tokens(spec: str) -> list[str]:
    """Vocabulary strings that the library splits off as one pre-token and
    encodes as one token.  ``spec`` is the content of the tokenizer file."""
    tok = Tokenizer.from_str(spec)
    back = {c: b for b, c in enumerate(byte_characters())}
    whole = []
    for shown in tok.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in shown).decode()
        except (KeyError, UnicodeDecodeError):
            continue  # part of a character: never a pre-token of its own
        if len(tok.pre_tokenizer.pre_tokenize_str(text)) == 1 and len(tok.model.tokenize(shown)) == 1:
            whole.append(text)
    return whole


class _Costs(dict):
    """Tokens by pre-token: 1 for the proven ones, merged when first met otherwise."""

    def __init__(self, tok: Tokenizer, whole: list[str]):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.model, self.byte = whole, tok.model, byte_characters()

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.whole) + MEMO:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = self[piece] = len(self.model.tokenize("".join(map(self.byte.__getitem__, piece.encode()))))
        return n


def make_counter(spec: str, whole: list[str]):
    """``count(text)``, equal to the library's count for every text."""
    tok = Tokenizer.from_str(spec)
    found = classes(tok)
    letters, numbers, spaces = (of_class(found, k) for k in "LNS")
    split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
                       rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+").findall
    costs, cut, odd = _Costs(tok, whole), cut_added(spec), needs_library().search

    def count(text: str) -> int:
        parts = cut(text)
        n = len(parts) // 2  # an added token is one token
        for part in parts[::2]:
            n += sum(map(costs.__getitem__, library_split(tok, part) if odd(part) else split(part)))
        return n

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    The file is read and the proof made once on the driver; both are as large
    as the vocabulary, whatever the corpus.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, prove_whole_tokens(spec)))

    def make():
        count = make_counter(*shared.value)
        return lambda i, n, text: (i, n, count(text))

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("text"))
    out = map_rows(src, make, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
