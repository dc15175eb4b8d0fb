"""Byte-level BPE encoding and decoding with the tokenizers library.

A rank file lists byte strings by rank; a rank is both the order of merging
and the id. A pattern cuts a text into matches; the library encodes a
match that a task has not met yet, and most of a text is matches met before.
It works on characters, so each byte is written as one printable character.
All ways to put a token together from two others become
merges of the token's rank, which is how rank files are meant to be read.
Decoding reverses the byte table; a character whose bytes are spread over
tokens belongs to the token that ends it.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, models, pre_tokenizers

from candlemill.llm.common import kept_batch, keeping, map_lean, slices

# Code points of one call to the library; longer texts are cut where the
# pattern has to end a match anyway.
PIECE_CHARS = 1 << 16
_ENCODE_BYTES = 1 << 20
_DECODE_IDS = 1 << 20
# What a task may remember of matches and their tokens, before it starts afresh,
# and what one of them takes besides its bytes.
_REMEMBERED_BYTES = 32 << 20
_ENTRY_BYTES = 200


def byte_characters() -> list[str]:
    """The character that stands for each byte.

    Printable Latin-1 characters stand for themselves; the others take the
    next code points from 256 on, in order.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def build_tokenizer(ranks: dict[bytes, int]) -> Tokenizer:
    """The library's tokenizer for a rank file; each text it gets is one match."""
    chars = byte_characters()

    def written(token: bytes) -> str:
        return "".join(chars[b] for b in token)

    merges = [
        (written(token[:i]), written(token[i:]))
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    vocab = {written(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


def byte_table(tokenizer: Tokenizer) -> list[bytes]:
    """Token bytes by id, by reversing the byte characters; empty where no id is."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    vocab = tokenizer.get_vocab()
    table = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        table[i] = bytes(byte_of[c] for c in token)
    return table


class Letters:
    """Bytes of all tokens in one array, to decode many ids at once."""

    def __init__(self, letters: np.ndarray, sizes: np.ndarray):
        self.letters, self.sizes = letters, sizes
        self.begins = np.cumsum(sizes) - sizes

    @staticmethod
    def arrays(tokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(t) for t in tokens], np.int64)
        return np.frombuffer(b"".join(tokens), np.uint8), sizes

    def decode(self, ids: np.ndarray) -> bytes:
        parts = []
        for start in range(0, len(ids), _DECODE_IDS):
            i = ids[start : start + _DECODE_IDS]
            sizes = self.sizes[i]
            ends = np.cumsum(sizes)
            shift = np.repeat(self.begins[i] - (ends - sizes), sizes)
            parts.append(self.letters[shift + np.arange(len(shift))].tobytes())
        return b"".join(parts)


_CUT = re.compile(r"(?<=\S)(?=[ \n])")


def pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """``text`` in parts of about ``limit`` code points, cut before white space.

    No match of a byte-level pattern holds white space after other characters,
    so tokens are those of the whole text.
    """
    cuts, at = [0], 0
    while len(text) - at > limit:
        found = _CUT.search(text, at + limit)
        if found is None:
            break
        at = found.start()
        cuts.append(at)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


# Types of the columns that encoding can add.
_OUTPUTS = {
    "ids": "array<int>",
    "packed": "binary",
    "n_tokens": "long",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def encode(
    df: DataFrame,
    keep: Sequence[str],
    vocab_path: str,
    pattern: str,
    text: str = "text",
    offsets: bool = False,
    outputs: Sequence[str] = ("ids", "packed"),
) -> DataFrame:
    """``keep`` columns and ``outputs``, by default ``ids`` and ``packed``.

    ``packed`` has the ids as little-endian uint32, ``n_tokens`` their number,
    ``ids_sha256`` the digest of ``packed``, ``decoded_sha256`` that of the bytes
    which the ids decode to, found in the same task. With ``offsets`` also
    ``starts`` and ``ends`` of each token in code points; tokens that share a
    character both cover it. A null or empty text has no ids. Special tokens'
    strings in a text are ordinary text. New columns that ``keep`` has already
    get underscores in front. ``pattern`` is in the language of the regex
    module. The vocabulary is read on the driver. A task gives back what it
    remembered when it ends.
    """
    ranks = load_ranks(vocab_path)
    saved = df.sparkSession.sparkContext.broadcast(build_tokenizer(ranks).to_str())
    added = [(name, _OUTPUTS[name]) for name in outputs]
    if offsets:
        added += [("starts", "array<int>"), ("ends", "array<int>")]
    kept = keeping(df, keep, text, added)
    names, read = kept.names, kept.value

    def learn(tokenizer: Tokenizer, memo: dict[str, bytes], spans: dict, matches: set[str]) -> None:
        new = [*matches.difference(memo)]
        if memo.get("", 0) > _REMEMBERED_BYTES:  # no match is empty
            memo.clear()
            spans.clear()
            new = [*matches]
        run = tokenizer.encode_batch if offsets else tokenizer.encode_batch_fast
        for match, found in zip(new, run(new, add_special_tokens=False)):
            memo[match] = array("i", found.ids).tobytes()
            if offsets:
                spans[match] = array("i", chain.from_iterable(found.offsets)).tobytes()
        grown = sum(len(m) + (3 if offsets else 1) * len(memo[m]) for m in new)
        memo[""] = memo.get("", 0) + grown + _ENTRY_BYTES * len(new)

    def encoded(tokenizer: Tokenizer, memo: dict, spans: dict, cut, texts: list[str]) -> list:
        """Ids, and places if wanted, of each text; all their new matches in one call."""
        matches = [cut.findall(t) for t in texts]
        learn(tokenizer, memo, spans, set().union(*matches))
        out = []
        for own in matches:
            ids = np.frombuffer(b"".join(map(memo.__getitem__, own)), np.int32)
            places = np.empty((0, 2), np.int32)
            if offsets and own:
                starts = accumulate(map(len, own[:-1]), initial=0)
                local = [np.frombuffer(spans[m], np.int32) + at for m, at in zip(own, starts)]
                places = np.concatenate(local).astype(np.int32).reshape(-1, 2)
            out.append((ids, places))
        return out

    def all_encoded(tokenizer: Tokenizer, memo: dict, spans: dict, cut, texts: list[str]) -> list:
        """The same for texts of any length, the longest piece by piece."""
        short = [t if len(t) <= PIECE_CHARS else "" for t in texts]
        out = encoded(tokenizer, memo, spans, cut, short)
        for row, text_ in enumerate(texts):
            if len(text_) > PIECE_CHARS:
                cuts = pieces(text_)
                found = [encoded(tokenizer, memo, spans, cut, [p])[0] for p in cuts]
                starts = accumulate(map(len, cuts[:-1]), initial=0)
                places = [place + at for (_, place), at in zip(found, starts)]
                out[row] = (
                    np.concatenate([ids for ids, _ in found]),
                    np.concatenate(places).astype(np.int32),
                )
        return out

    def lists(values: Sequence[np.ndarray]) -> pa.Array:
        ends = np.cumsum([0, *map(len, values)])
        flat = np.concatenate(values) if values else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    def column(name: str, ids: Sequence[np.ndarray], letters: Letters | None) -> pa.Array:
        if name == "ids":
            return lists(ids)
        if name == "n_tokens":
            return pa.array([len(i) for i in ids], pa.int64())
        if name == "packed":
            return pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
        raw = (letters.decode(i) if name == "decoded_sha256" else i.astype("<u4").tobytes() for i in ids)
        return pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string())

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer, memo, places = Tokenizer.from_str(saved.value), {}, {}
        decodes = "decoded_sha256" in outputs
        letters = Letters(*Letters.arrays(byte_table(tokenizer))) if decodes else None
        cut = regex.compile(pattern)
        try:
            for part in slices(batches, read, _ENCODE_BYTES):
                texts = [t or "" for t in part.column(read).to_pylist()]
                ids, spans = zip(*all_encoded(tokenizer, memo, places, cut, texts))
                new = [column(name, ids, letters) for name in outputs]
                if offsets:
                    new += [lists([s[:, 0] for s in spans]), lists([s[:, 1] for s in spans])]
                yield kept_batch(part, names, *new)
        finally:
            del tokenizer, letters
            memo.clear()
            places.clear()

    return map_lean(kept.source, mapper, kept.schema)


def decode(df: DataFrame, keep: Sequence[str], vocab_path: str, ids: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded``, the bytes that the ids stand for.

    Null or empty ids give no bytes. Ids that the vocabulary lacks, negative
    ones and null ids are an error, as no bytes could stand for them. The bytes
    need not be whole characters: see ``token_texts`` for a readable form.
    """
    tokenizer = build_tokenizer(load_ranks(vocab_path))
    saved = df.sparkSession.sparkContext.broadcast(Letters.arrays(byte_table(tokenizer)))
    kept = keeping(df, keep, ids, [("decoded", "binary")])
    names, read = kept.names, kept.value

    def mapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(*saved.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                part = whole.slice(start, 256)
                column = part.column(read)
                flat = column.flatten()
                values = flat.to_numpy(zero_copy_only=False)
                if flat.null_count or (values < 0).any():
                    raise ValueError("ids must be whole numbers from 0")
                lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
                ends = np.cumsum(lengths)
                decoded = [letters.decode(values[b - n : b]) for n, b in zip(lengths, ends)]
                yield kept_batch(part, names, pa.array(decoded, pa.binary()))

    return kept.source.mapInArrow(mapper, kept.schema)


def token_texts(tokens: Sequence[bytes]) -> list[str]:
    """What each token adds to the text; a split character goes to the token that ends it.

    Bytes that belong to no character become U+FFFD.
    """
    reader = codecs.getincrementaldecoder("utf-8")(errors="replace")
    texts = [reader.decode(t) for t in tokens]
    if texts:
        texts[-1] += reader.decode(b"", final=True)
    return texts
