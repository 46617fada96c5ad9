"""Exact cutting of texts into units a byte-pair model encodes independently of each other.

A unit is a pre-token of the tokenizer.  Texts are first cut at single spaces in
Arrow, the distinct parts are cut further in Python, so the costly work is done
once per distinct part.  Where cutting at spaces could change a result (runs of
white space, unusual characters, special strings) the library itself cuts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from gildstar.llm.common import encode_words, expand

# Fixed value: the byte-level splitting pattern of this tokenizer family.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Texts in which a cut before each space is not a cut between pre-tokens, or white space is unusual.
_UNUSUAL = (
    r"  | \n|\n | $|"
    "[\t\r\x0b\x0c\x1c-\x1f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_PLAIN = regex.compile(r"[\n\x20-\x7e\u00a1-\u00ff]*")


@functools.lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """Byte -> the character that stands for it: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def byte_level(text: str) -> str:
    return text.encode("utf-8").decode("latin-1").translate(byte_alphabet())


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class BytePretokens:
    """Pre-tokens of a byte-level tokenizer without normalizer."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.specials = sorted(
            (t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True
        )
        self._special = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self._pattern = regex.compile(BYTE_PATTERN)

    def by_library(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text and its number of special tokens."""
        pieces: list[str] = []
        parts = self._special.split(text)
        for part in parts:
            pieces += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return pieces, len(parts) - 1

    def cut(self, part: str) -> list[str]:
        if _PLAIN.fullmatch(part):
            return self._pattern.findall(part)
        return [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]

    def of_texts(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and for every occurrence its text's position and its pre-token's,
        and the number of special tokens per text."""
        known: dict[str, int] = {}
        odd = np.asarray(pc.match_substring_regex(texts, _UNUSUAL))
        for special in self.specials:
            odd |= np.asarray(pc.match_substring(texts, special))
        special_counts = np.zeros(len(texts), np.int64)
        owners, units = [], []

        usual = np.flatnonzero(~odd)
        lists = pc.split_pattern(texts.take(pa.array(usual)), " ")
        per_text = np.diff(lists.offsets.to_numpy())
        codes, parts = encode_words(lists.flatten())
        # A part that opens its text has no space before it.
        opens = np.zeros(len(codes), np.int64)
        opens[(np.cumsum(per_text) - per_text)[per_text > 0]] = 1
        used, codes = np.unique(codes * 2 + opens, return_inverse=True)
        texts_of = parts.to_pylist()
        flat: list[int] = []
        lengths = np.empty(len(used), np.int64)
        for i, code in enumerate(used.tolist()):
            part = texts_of[code >> 1]
            pieces = self.cut(part if code & 1 else " " + part)
            lengths[i] = len(pieces)
            for piece in pieces:
                flat.append(known.setdefault(piece, len(known)))
        owner = np.repeat(usual, per_text)
        owners.append(np.repeat(owner, lengths[codes]))
        units.append(np.array(flat, np.int64)[expand(codes, np.cumsum(lengths) - lengths, lengths)])

        for i in np.flatnonzero(odd).tolist():
            pieces, special_counts[i] = self.by_library(texts[i].as_py())
            owners.append(np.full(len(pieces), i))
            units.append(np.array([known.setdefault(p, len(known)) for p in pieces], np.int64))
        return list(known), np.concatenate(owners), np.concatenate(units).astype(np.int64), special_counts

    def count(self, pretoken: str) -> int:
        """The number of tokens the model makes of a pre-token."""
        return len(self.tokenizer.model.tokenize(byte_level(pretoken)))
