"""Byte-level BPE encoding and decoding (operator 6).

Each Arrow batch of texts is split by the pre-token pattern; the distinct
pieces a worker has not met yet go through the ``tokenizers`` library, whose
alphabet stands for bytes by printable characters. A piece's ids and its
tokens' limits are then put together for every text. Decoding reverses the
byte table: ids become bytes, and a character split between tokens is only
whole again once its bytes are joined.

Null texts count as empty: no tokens. Every row gives a row, whatever its id,
repeated rows included. An empty table gives no rows. A very long text is split
and encoded whole. Columns other than id, text and (``tokenized``) source are
not read, whatever their names. Ties don't occur: of equal merges the leftmost
comes first, as in the library.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from aerolens.llm.common import column, documents, give_back, held, one_thread, text_array

#: Pieces a worker remembers before it starts anew.
KEPT_PIECES = 80_000

#: Characters that Unicode calls white space, spelled out because Python's own
#: class holds four control characters more.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: The bytes that byte-level vocabularies write as themselves.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_alphabet() -> list[str]:
    """The character for each byte: itself if printed, else the next one from 256 on."""
    others = iter(range(256, 512))
    return [chr(b) if b in set(PRINTED) else chr(next(others)) for b in range(256)]


def piece_pattern(pattern: str) -> str:
    """The public pattern with its white-space classes spelled out."""
    parts = regex.split(r"(\\s|\\S|\[\^)", pattern)
    out, in_class = [], False
    for part in parts:
        if part == r"\s":
            out.append(SPACE if in_class else f"[{SPACE}]")
        elif part == r"\S":
            out.append(f"[^{SPACE}]")
        elif part == "[^":
            in_class = True
            out.append(part)
        else:
            if "]" in part:
                in_class = False
            out.append(part)
    return "".join(out)


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks_file: str, pattern: str):
        one_thread()
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        alphabet = byte_alphabet()
        spell = lambda token: "".join(alphabet[b] for b in token)
        merges = []
        for token in sorted(ranks, key=ranks.get):
            halves = [(token[:i], token[i:]) for i in range(1, len(token))]
            known = sorted((ranks[a], ranks[b], a, b) for a, b in halves if a in ranks and b in ranks)
            merges += [(spell(a), spell(b)) for _, _, a, b in known]
        vocabulary = {spell(token): rank for token, rank in ranks.items()}
        self.model = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = regex.compile(piece_pattern(pattern))
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        spelled = bytearray(int(self.starts[-1]))
        for token, rank in ranks.items():
            spelled[self.starts[rank] : self.starts[rank] + len(token)] = token
        self.bytes = np.frombuffer(bytes(spelled), np.uint8)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encodes pieces not met before."""
        if len(self.known) > KEPT_PIECES:
            self.known.clear()
        new = list(pieces - self.known.keys())
        for piece, found in zip(new, self.model.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, at = [], 0
        while at < len(texts):  # some texts at a time, so that their pieces stay few
            pieces, size = [], 0
            while at + len(pieces) < len(texts) and size < 500_000:
                text = texts[at + len(pieces)]
                pieces.append(self.split.findall(text))
                size += len(text)
            self.learn(set().union(*pieces))
            known = self.known.__getitem__
            out += [b"".join(map(known, found)) for found in pieces]
            at += len(pieces)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for; tokens may end inside a character."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids) or not ends[-1]:
            return b""
        where = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.bytes[where].tobytes()

    def limits(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end character of each token (end exclusive); a token that
        holds only part of a character covers that character."""
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        leading = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        character = np.cumsum(leading) - 1
        if not len(ids):
            return starts, ends
        return character[starts], character[ends - 1] + 1


def codec(ranks_file: str, pattern: str) -> Codec:
    return held(("codec", ranks_file, pattern), lambda: Codec(ranks_file, pattern))


def byte_bpe(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids, starts and ends (characters of each token), decoded (binary)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(ranks_file, pattern)
        for batch in batches:
            for rows in range(0, batch.num_rows, 256):
                part = batch.slice(rows, 256)
                texts = text_array(part).to_pylist()
                ids = [np.frombuffer(x, "<u4") for x in code.encode(texts)]
                limits = [code.limits(i, t) for i, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                        pa.array([x.astype(np.int32) for x, _ in limits], pa.list_(pa.int32())),
                        pa.array([x.astype(np.int32) for _, x in limits], pa.list_(pa.int32())),
                        pa.array([code.decode(i) for i in ids], pa.binary()),
                    ],
                    ["doc_id", "ids", "starts", "ends", "decoded"],
                )
        code.known.clear()
        give_back(keep=True)

    schema = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded binary"
    return documents(df, id_col, text_col).mapInArrow(encode, schema)


def _digests(ranks_file: str, pattern: str, keep: int, with_ids: bool):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(ranks_file, pattern)
        for batch in batches:
            for rows in range(0, batch.num_rows, 500):
                part = batch.slice(rows, 500)
                packed = code.encode(text_array(part).to_pylist())
                decoded = [code.decode(np.frombuffer(x, "<u4")) for x in packed]
                columns = {part.schema.names[k]: part.column(k) for k in range(keep)}
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in packed]))).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4"))
                    )
                columns["n_tokens"] = pa.array([len(x) // 4 for x in packed], pa.int64())
                columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())
                yield pa.RecordBatch.from_pydict(columns)
        code.known.clear()  # the worker may go on with something else
        give_back(keep=True)

    return digest


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_bpe_digest(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the packed ids and of the decoded bytes,
    without handing the ids themselves back to Spark."""
    docs = documents(df, id_col, text_col)
    return docs.mapInArrow(_digests(ranks_file, pattern, 1, False), f"doc_id long, {DIGESTS}")


def tokenized(
    df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """doc_id, source, ids and their digests: the tokens to train on."""
    docs = df.select(
        column(df, id_col).cast("long").alias("doc_id"),
        column(df, source_col).cast("string").alias("source"),
        column(df, text_col).cast("string").alias("text"),
    )
    return docs.mapInArrow(
        _digests(ranks_file, pattern, 2, True), f"doc_id long, source string, ids array<int>, {DIGESTS}"
    )
