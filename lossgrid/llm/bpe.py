"""Byte-level BPE by longest matches and adjacency, with the same result as merging pair by pair.

The final tokens of a piece are the only sequence of tokens in which every token is what merging makes of its own bytes
and no two neighbours would have been joined by an earlier merge.  So a piece is read from left to right, always taking
the longest token that may follow the one before; where none may, the last token is given up for its next shorter
prefix.  A position that failed once is never entered again, which bounds the work by the length of the piece.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import free_names, text_of

#: A worker remembers pieces of up to so many characters, twice so many pieces; others are encoded anew each time.
MEMO_CHARS, MEMO_PIECES = 40, 150_000

#: Neighbour pairs remembered by a task.
MEMO_PAIRS = 500_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def merge_slowly(piece: bytes, ranks: dict[bytes, int]) -> tuple[list[bytes], tuple[bytes, bytes] | None]:
    """Merging by definition: always the leftmost pair of lowest rank.  Returns the parts and the last pair joined."""
    parts, last = [piece[i : i + 1] for i in range(len(piece))], None
    while len(parts) > 1:
        best = min((ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
        if best[0] == sys.maxsize:
            break
        i = best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


class Vocabulary:
    """Tokens that merging can produce, how each came about, and which may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts, last = merge_slowly(token, ranks)
                if len(parts) > 1:
                    continue  # merging never arrives at this token
                self.halves[rank] = (ranks[last[0]], ranks[last[1]])
            self.matcher.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.whole = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        #: longest proper prefix of a token that is a token
        self.shorter: dict[int, int | None] = {}
        for rank in [r for r in self.bytes_of if len(self.bytes_of[r]) == 1 or r in self.halves]:
            token = self.bytes_of[rank].decode("latin-1")
            found = max((n for n in range(1, len(token)) if self.matcher.exists(token[:n])), default=0)
            self.shorter[rank] = self.matcher.get(token[:found])[0] if found else None
        self.matcher.make_automaton()
        #: by left rank << 32 | right rank
        self.may_follow: dict[int, bool] = {}
        self.memo: dict[str, list[int]] = {}
        self.old_memo: dict[str, list[int]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that lay at one edge (0: left, 1: right) while ``token`` grew, each with the rank that ended it."""
        edge, ended = [], sys.maxsize
        while True:
            edge.append((token, ended))
            if token not in self.halves:
                return edge
            token, ended = self.halves[token][side], token

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before the merges that end what lies at it on either side."""
        fits = True
        for a, a_ended in self._edge(left, 1):
            for b, b_ended in self._edge(right, 0):
                rank = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
                # of equal ranks the leftmost pair is joined first
                if rank is not None and rank < a_ended and rank <= b_ended:
                    fits = False
        if len(self.may_follow) >= MEMO_PAIRS:
            self.may_follow.clear()
        self.may_follow[left << 32 | right] = fits
        return fits

    def encode(self, piece: str) -> list[int]:
        """Ranks of a piece given as Latin-1 text of its bytes."""
        whole = self.whole.get(piece)
        if whole is not None:  # a whole piece is looked up before anything is merged
            return [whole]
        size = len(piece)
        best = [0] * size
        for end, (rank, back) in self.matcher.iter(piece):
            best[end - back] = rank  # ends only grow, so the last one is the longest
        lengths, known = self.lengths, self.may_follow
        failed = None  # positions given up; few pieces need any
        token, at, left, out = best[0], 0, -1, []
        while True:
            end = at + lengths[token]
            fits = failed is None or not failed[end]
            if fits and left >= 0:
                fits = known.get(left << 32 | token)
                if fits is None:
                    fits = self.compatible(left, token)
            if fits:
                out.append(token)
                if end == size:
                    return out
                at, left, token = end, token, best[end]
                continue
            token = self.shorter[token]
            while token is None:  # nothing fits here: give the token before up
                if failed is None:
                    failed = bytearray(size + 1)
                failed[at] = 1
                token = out.pop()
                at -= lengths[token]
                token = self.shorter[token]
                left = out[-1] if out else -1

    def encode_text(self, text: str, pattern) -> list[int]:
        """Ranks of a text, each match of ``pattern`` by itself."""
        memo, out = self.memo, []
        for piece in pattern.findall(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.old_memo.get(piece)
                if ids is None:
                    ids = self.encode(piece.encode("utf-8").decode("latin-1"))
                if len(piece) <= MEMO_CHARS:
                    if len(memo) >= MEMO_PIECES:  # what was not met since the last turn is forgotten
                        self.old_memo, self.memo = memo, {}
                        memo = self.memo
                    memo[piece] = ids
            out += ids
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, built once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(read_ranks(path))
    return _loaded[path]


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


def encode_texts(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``docs`` with the packed ids of every whole text and the bytes they decode to.

    Adds ``ids_col`` (binary, four bytes an id), ``decoded`` (binary) and ``n_tokens``; columns of these names are
    replaced.  Null and empty texts have no ids.  Repeated rows are encoded alike, other columns pass through.
    """
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType

    (work,) = free_names(docs, "_encoded")
    made = (ids_col, "decoded", "n_tokens")
    schema = StructType(
        [StructField("ids", BinaryType()), StructField("decoded", BinaryType()), StructField("n", LongType())]
    )

    @F.pandas_udf(schema)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import regex

        vocab, split = vocabulary(ranks_path), regex.compile(pattern)
        for texts in batches:
            rows = []
            for text in texts:
                ids = vocab.encode_text(text, split)
                rows.append((packed(ids), vocab.decode(ids), len(ids)))
            yield pd.DataFrame(rows, columns=["ids", "decoded", "n"])

    kept = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c.lower() not in {m.lower() for m in made}]
    return docs.withColumn(work, encoded(text_of(text_col))).select(
        *kept,
        F.col(work)["ids"].alias(ids_col),
        F.col(work)["decoded"].alias("decoded"),
        F.col(work)["n"].alias("n_tokens"),
    )


def token_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of the ids and of the decoded bytes."""
    return encode_texts(docs.select("doc_id", "text"), ranks_path, pattern).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

