"""Token counts by the whole-token shortcut.

Offline, every vocabulary string is put to the tokenizer alone; those that are one pre-token and
encode as one token are proven singles. In a text, pre-tokens found among them count one each without
any merging; only the rest go through the tokenizer's merges, once per distinct string of a worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

#: The byte-level pre-token pattern, a fixed value of this vocabulary's tokenizer.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes do not depend on a library's Unicode version or its notion of white space.
#: A text with any other goes to the tokenizer whole.
PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-ͷΑ-ΡΣ-ҁ‐-‧‰-⁞€ぁ-ゖァ-ヺ一-龥가-힣]*"
REMEMBERED = 1_000_000


def special_strings(tokenizer: Tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def proven_singles(tokenizer: Tokenizer) -> list[str]:
    """Vocabulary strings that are one pre-token and encode alone as one token; at most the vocabulary."""
    special = set(special_strings(tokenizer))
    whole = regex.compile(PRE_TOKEN)
    size = tokenizer.get_vocab_size(with_added_tokens=False)
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in range(size)]
    texts = [t for t in texts if t and t not in special and "�" not in t and whole.match(t).end() == len(t)]
    return [t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)) if len(e.ids) == 1]


class Counter(dict):
    """Tokens of a pre-token; what is missing is merged by the tokenizer and remembered, up to a bound on memory."""

    def __init__(self, tokenizer: Tokenizer, singles: list[str]):
        super().__init__(dict.fromkeys(singles, 1))
        self.tokenizer, self.proven = tokenizer, singles

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.proven) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.proven, 1))
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= 64:
            self[piece] = n
        return n


def count_tokens(documents: DataFrame, tokenizer_json: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text, as the tokenizer itself counts them:
    no begin or end tokens, special strings inside a text taken as special tokens, no truncation.

    A null or empty text has 0 bytes and tokens; a null doc_id and repeated rows are kept; an empty
    table gives no rows; other columns are ignored.
    """
    tokenizer = _tokenizer(tokenizer_json)
    singles = proven_singles(tokenizer)
    special = special_strings(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizer(tokenizer_json)
        counts = Counter(own, singles)
        find, plain = regex.compile(PRE_TOKEN).findall, regex.compile(PLAIN).fullmatch
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                if plain(text) and not any(s in text for s in special):
                    tokens.append(sum(map(counts.__getitem__, find(text))))
                else:
                    tokens.append(len(own.encode(text, add_special_tokens=False).ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([t > limit for t in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def _tokenizer(tokenizer_json: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
