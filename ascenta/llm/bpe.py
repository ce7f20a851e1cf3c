"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re

from pyspark.sql import DataFrame

from .common import map_arrow, per_process

#: Texts are cut near this many characters before they reach the library.
PIECE_CHARS = 1 << 16
#: A run of white space as long as this reaches the merges without the pattern matcher.
RUN_CHARS = 1 << 12
#: What the pattern's \\s means to the library; Python's \\s has four control characters more.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHANGE = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_LONG_RUN = re.compile(f"[{_WHITE}]{{{RUN_CHARS},}}")


def encoder(ranks_path: str, pattern: str):
    """The tiktoken encoding of a rank file: lines of base64 bytes and their rank."""

    def make():
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return per_process(("encoder", ranks_path, pattern), make)


def safe_pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """*text* in pieces of about *size* characters that no match of the pattern spans.

    Every match is white space followed by at most one run of other
    characters, so a change from other characters to white space is always a
    boundary, and the pattern looks behind nowhere. Where a stretch of over *size*
    characters has no such place, the piece is as long as the stretch.
    """
    pieces, start = [], 0
    while len(text) - start > size:
        cut = _CHANGE.search(text, start + size)
        if cut is None:
            break
        pieces.append(text[start : cut.start()])
        start = cut.start()
    pieces.append(text[start:])
    return pieces


def encode_text(text: str, ranks_path: str, pattern: str) -> list[int]:
    """Ids of the whole text, as the library gives them for each match of the pattern.

    White space of thousands of characters would overflow the library's matcher:
    all of such a run but its last character is one match (the whole run at the
    end of the text), so it goes to the merges directly.
    """
    own = encoder(ranks_path, pattern)
    if len(text) <= RUN_CHARS:
        return own.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        for piece in safe_pieces(text[start : run.start()]):
            ids.extend(own.encode_ordinary(piece))
        ids.extend(own._encode_single_piece(text[run.start() : end]))
        start = end
    for piece in safe_pieces(text[start:]):
        ids.extend(own.encode_ordinary(piece))
    return ids


def _unpacked(own, packed: bytes | None) -> bytes:
    import numpy as np

    return own.decode_bytes(np.frombuffer(packed or b"", dtype="<u4").tolist())


def encode_bpe(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """One row per input row: *id_col*, n_tokens and token_ids (little-endian unsigned 32-bit, packed).

    With *decode*, also ``decoded``, the raw bytes of those packed ids, made in the
    same pass: one Python worker a task holds one copy of the ranks.

    Null text counts as empty and gives no ids; no special token is made, so
    their strings are ordinary text. Other columns are not read. Each text is encoded
    alone and whole; long ones in pieces cut at safe boundaries.
    """
    kind = df.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "token_ids", *["decoded"] * decode]

    def kernel(batches):
        import numpy as np
        import pyarrow as pa

        own = encoder(ranks_path, pattern)
        for batch in batches:
            packed = [np.asarray(encode_text(t or "", ranks_path, pattern), dtype="<u4").tobytes() for t in batch.column(1).to_pylist()]
            out = [batch.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()), pa.array(packed, pa.binary())]
            if decode:
                out.append(pa.array([_unpacked(own, p) for p in packed], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names)

    out = map_arrow(df.select(id_col, text_col), kernel, f"id {kind}, n_tokens long, token_ids binary" + ", decoded binary" * decode)
    return out.withColumnRenamed("id", id_col)


def decode_bpe(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids") -> DataFrame:
    """*df* with ``decoded``: the raw bytes of each row's packed ids, which need not be valid UTF-8 by token.

    Null ids decode to no bytes; an id without a rank raises.
    """
    if "decoded" in df.columns:
        df = df.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    at = df.columns.index(ids_col)

    def kernel(batches):
        import pyarrow as pa

        own = encoder(ranks_path, pattern)
        for batch in batches:
            raw = [_unpacked(own, p) for p in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, "decoded"])

    return map_arrow(df, kernel, f"{schema}, decoded binary")
