"""Token ids of whole texts from public vocabularies, one distinct stretch of text at a time."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes that may follow a blank where a text is cut: no blank, control or special token begins with them, nor does a blank beyond ASCII
PLAIN = np.ones(256, bool)
PLAIN[[*range(0x21), 0x3C, 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts (not null) side by side, and where each begins, with the end of the last."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def from_bytes(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Strings or binary values that stand side by side in ``data``."""
    parts = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, parts)


def safe_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places at which no token of either vocabulary lies across: the beginnings of texts that are not empty, and single
    blanks before a plain character.

    The byte-level vocabulary splits in front of such a blank before it merges anything; no piece of the other has a
    blank after another character (:func:`piece_table` checks it).
    """
    mark = np.zeros(len(data), bool)
    if len(data):
        blank = data == 0x20
        mark[1:-1] = blank[1:-1] & ~blank[:-2] & PLAIN[data[2:]]
        mark[offsets[1:][np.diff(offsets) > 0] - 1] = False
        mark[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(mark)


#: of ASCII: letters and digits, and signs before which a run of them always ends (none of a special token's name)
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in "\n!\"#$%&()*+,-./:;=?@[]{}~"]] = True


def finer_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """:func:`safe_cuts`, and more that are safe for the byte-level vocabulary alone: between a letter or digit and a sign
    after it, and after a single line break between a sign, letter or digit and a letter or digit."""
    mark = np.zeros(len(data), bool)
    mark[safe_cuts(data, offsets)] = True
    if len(data):
        word = ALNUM[data]
        mark[1:] |= word[:-1] & SIGN[data[1:]]
        solid = (data > 0x20) & (data < 0x7F)
        mark[2:] |= solid[:-2] & (data[1:-1] == 0x0A) & word[2:]
    return np.flatnonzero(mark)


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each (start, size) in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Encoder:
    """Encodes texts by their stretches between safe cuts; ids of stretches seen before are remembered, ``most`` at once."""

    def __init__(self, encode: Callable[[list[str]], Iterable], most: int = 300_000, longest: int = 200):
        self.encode, self.most, self.longest = encode, most, longest
        self.known: dict[str, bytes] = {}

    def distinct(self, stretches: list[str]) -> list[bytes]:
        found = [self.known.get(s) for s in stretches]
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
        for i, ids in zip(new, self.encode([stretches[i] for i in new])):
            found[i] = array("I", ids).tobytes()
            if len(stretches[i]) <= self.longest:
                self.known[stretches[i]] = found[i]
        return found

    def ids(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each stretch has, and all of them in a row."""
        found = self.distinct(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        codes = coded.indices.to_numpy()
        return sizes[codes], flat[gather((np.cumsum(sizes) - sizes)[codes], sizes[codes])]


def stretches_of(texts: pa.Array, cut: Callable = safe_cuts) -> tuple[np.ndarray, pa.DictionaryArray]:
    """How many stretches each text has, and all of them as numbers of distinct ones."""
    data, offsets = text_bytes(texts)
    cuts = cut(data, offsets)
    flat = from_bytes(data, np.append(cuts, len(data)), pa.string())
    return np.diff(np.searchsorted(cuts, offsets)), flat.dictionary_encode()


def totals(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of the next ``counts[i]`` of ``sizes``, for each i."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.concatenate([[0], np.cumsum(counts)])
    return np.diff(ends[at])


def byte_level(path: str, plain: bool = False):
    """The byte-level vocabulary at ``path``; ``plain``: names of special tokens in a text are ordinary text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path)
    vocabulary.encode_special_tokens = plain
    return vocabulary


def byte_entries(vocabulary) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary.

    Its entries write printable bytes as themselves and the others, in order, as the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    to_latin = {0x100 + i: b for i, b in enumerate(hidden)}
    out = [b""] * vocabulary.get_vocab_size()
    for entry, number in vocabulary.get_vocab().items():
        out[number] = entry.translate(to_latin).encode("latin-1")
    return out


def byte_encoder(path: str, plain: bool = False) -> tuple[Encoder, list[bytes]]:
    """An encoder with the byte-level vocabulary at ``path``, and the bytes of each id.

    Stretches of printable Latin characters up to U+024F take a faster reader of the same merges; the others, and names of special
    tokens, the vocabulary's own.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    vocabulary = byte_level(path, plain)
    entries = byte_entries(vocabulary)
    special = {t.content for t in vocabulary.get_added_tokens_decoder().values()}
    ranks = {b: i for i, b in enumerate(entries) if b.decode("latin-1") not in special}
    fast = tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    simple = re.compile("[\n -{}~¡-¬®-ɏ]*").fullmatch

    def encode(texts: list[str]) -> list:
        out = [fast(t) if simple(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, vocabulary.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False) if rest else []):
            out[i] = found.ids
        return out

    return Encoder(encode), entries


def pieces_at(path: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path)


def piece_encoder(path: str) -> Encoder:
    """Encodes stretches that begin with a blank, which the vocabulary itself puts in front."""
    vocabulary = pieces_at(path)
    return Encoder(lambda texts: vocabulary.encode([t[1:] for t in texts], num_threads=1) if texts else [])


def piece_table(path: str) -> list[bytes]:
    """The bytes of each id: U+2581 is a blank, <0xHH> the byte HH. No piece may have a blank after another character."""
    vocabulary = pieces_at(path)
    out = []
    for i in range(vocabulary.get_piece_size()):
        piece = vocabulary.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError(f"piece {i} has a blank inside: texts cannot be cut at blanks")
        out.append(bytes([int(piece[3:5], 16)]) if vocabulary.is_byte(i) else piece.replace("▁", " ").encode())
    return out


def clean(texts: pa.Array) -> pa.Array:
    """Null texts as empty ones."""
    return pc.fill_null(texts, "")
