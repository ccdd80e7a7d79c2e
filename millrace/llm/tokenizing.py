"""Splitting of texts as two public tokenizers do it, and their encodings of a word.

Texts of plain Latin letters, digits and punctuation are split with an
expression that agrees with the library on these characters.  Any other text is
split, or encoded as a whole, by the library.
"""

import functools
import os
import re

import numpy as np

REMEMBERED = 300_000

_LATIN = "À-įı-ňŊ-ſ"
_PLAIN = re.compile(f"[\t\n\r -~{_LATIN}]*")
_LETTER = "A-Za-zÀ-ÖØ-öø-įı-ňŊ-ſ"
_BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^ \t\n\r0-9{_LETTER}]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+"
)
_WORD_LEVEL = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^ \t\n\r0-9{_LETTER}]+")


@functools.cache
def tokenizer(path: str):
    """The tokenizer of a file, without truncation and padding; one per process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@functools.cache
def _specials(path: str):
    names = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    return re.compile("(" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + ")") if names else None


def byte_level_split(text: str, path: str) -> list[str]:
    """The units that a byte-level BPE encodes one by one; joined they are the text."""
    if "<" not in text and _PLAIN.fullmatch(text):
        return _BYTE_LEVEL.findall(text)
    specials, cut = _specials(path), tokenizer(path).pre_tokenizer.pre_tokenize_str
    out = []
    for at, part in enumerate(specials.split(text) if specials else [text]):
        if at % 2:
            out.append(part)
        elif part:
            out.extend(part[a:b] for _, (a, b) in cut(part))
    return out


def encode_word(word: str, path: str) -> list[int]:
    return tokenizer(path).encode(word, add_special_tokens=False).ids


def byte_pieces(path: str) -> list[bytes]:
    """The bytes each id stands for, by id, for a byte-level vocabulary."""
    to_byte = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for piece, number in vocabulary.items():
        known = all(c in to_byte for c in piece)
        pieces[number] = bytes(to_byte[c] for c in piece) if known else piece.encode()
    return pieces


def _model_word(word: str, path: str) -> list[int]:
    """Ids of one word that needs no further splitting, straight from the merges."""
    return [t.id for t in tokenizer(path).model.tokenize(word.encode().decode("latin-1").translate(_BYTE_LETTERS))]


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + at) for at, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class WordIds(dict):
    """Ids of lower-case words as little-endian 32-bit bytes.

    Remembered for all tasks of a process, and forgotten beyond a number of words.
    """

    REMEMBERED = 800_000

    def __init__(self, path):
        self.path = path

    def __missing__(self, word):
        if len(self) >= self.REMEMBERED:
            self.clear()
        found = self[word] = np.array(_model_word(word, self.path), "<u4").tobytes()
        return found

    def of_text(self, text: str) -> bytes:
        """Ids of a text for a vocabulary that lowers case and drops white space."""
        if "<" not in text and _PLAIN.fullmatch(text):
            return b"".join(map(self.__getitem__, _WORD_LEVEL.findall(text.lower())))
        return np.array(encode_word(text, self.path), "<u4").tobytes()


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
