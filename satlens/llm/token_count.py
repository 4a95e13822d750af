"""Token counts of whole texts with a whole-token shortcut.

``prove_whole_tokens`` runs once, on the driver, over the vocabulary (bounded by
its size): a vocabulary string counts as whole when the library encodes it,
alone, as exactly that one token.  On the executors every pre-token that is such
a string counts as 1 without merging; only the others go through the library's
merges, once per distinct pre-token and worker.

Null texts count as empty (0 bytes, 0 tokens); texts are never truncated;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from satlens.llm.pretokens import PieceEncoder, byte_alphabet

#: End-of-word mark of vocabularies that keep one.
WORD_END = "</w>"
_COUNTERS: dict[str, PieceEncoder] = {}


def prove_whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings that encode alone as one token, as plain text."""
    enc = PieceEncoder(path)
    back = {c: b for b, c in byte_alphabet().items()}
    mark = enc.library.model.end_of_word_suffix or ""
    special = set(enc.specials)
    candidates, ids = [], []
    for token, i in enc.library.get_vocab(with_added_tokens=False).items():
        if token in special or not token.endswith(mark):
            continue
        shown = token[:len(token) - len(mark)]
        if not shown or any(c not in back for c in shown):
            continue
        try:
            candidates.append(bytes(back[c] for c in shown).decode())
        except UnicodeDecodeError:  # part of a character: never a pre-token
            continue
        ids.append(i)
    return frozenset(t for t, i, got in zip(candidates, ids, enc.library_pieces(candidates)) if got == [i])


def counter(path: str, whole: frozenset[str]) -> PieceEncoder:
    """One per Python worker; its memo holds a token count for each pre-token."""
    if path not in _COUNTERS:
        enc = PieceEncoder(path)

        def count(pieces: list[str]) -> list[list[int]]:
            rest = [p for p in pieces if p not in whole]
            merged = iter(enc.library_pieces(rest))
            return [[1] if p in whole else [len(next(merged))] for p in pieces]

        enc.encode_pieces = count
        enc.encode_text = lambda t: [len(enc.library.encode(t, add_special_tokens=False).ids)]
        _COUNTERS[path] = enc
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``; other columns are not read."""
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(tokenizer))

    def run(batches):
        enc = counter(tokenizer, whole.value)
        for b in batches:
            texts = b.column(1).to_pylist()
            n = [int(x.sum()) for x in enc.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
