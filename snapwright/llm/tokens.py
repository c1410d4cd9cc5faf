"""Token ids of whole texts with a public vocabulary, as little-endian unsigned 32-bit bytes."""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np

#: Fixed value: the split rule of the word vocabulary. It drops white space and never looks across it.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Stands between words that are encoded together; words that hold it are encoded alone.
MARK = "\x01"


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of one of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Marks in a row are one token by the split rule; a full stop or comma behind a letter and before a blank is one alone.
_MARKS_IN_A_ROW = re.compile(r"(?:[^\w\s]|_)[.,][ \n]")
#: Characters that may combine with, or change, their neighbours under normalisation or lower-casing.
_CONTEXT = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(0x300, 0x11_0000)) if unicodedata.category(c)[0] == "M") + "\u0130\u03a3\u1100-\u11ff]")


def _stands_alone(text: str) -> bool:
    """Whether no character's normal form or lower case depends on its neighbours."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _CONTEXT.search(text) is None
    return True


def _words(text: str) -> list[str]:
    """Pieces between blanks, in lower case, with lone full stops and commas cut off."""
    text = text.lower().replace("\n", " ")
    if _MARKS_IN_A_ROW.search(text) is None:
        text = text.replace(". ", " . ").replace(", ", " , ")
    return text.split(" ")


class TextEncoder:
    """Encodes texts with one ``tokenizers`` file.

    Where the file's rules never look across white space, each distinct word is encoded once by the library and
    looked up afterwards; the ids are those of the whole text. Other files are given the whole texts, and so are
    texts in which characters depend on their neighbours. Words are remembered in two generations: when the younger
    is full it becomes the older, and words that are met again move back, so frequent words stay.
    """

    def __init__(self, path: str, remembered: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as opened:
            rules = json.load(opened)
        self.by_words = _ignores_white_space(rules)
        mark = self._library_ids([MARK])[0]
        self.mark = int(mark[0]) if len(mark) == 1 else None

    @property
    def width(self) -> int:
        """Bytes that the largest id needs, 2 or 4."""
        return 2 if self.library.get_vocab_size() <= 1 << 16 else 4

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_words or self.mark is None:
            return [ids.tobytes() for ids in self._library_ids(texts)]
        pieces = [_words(text) if _stands_alone(text) else None for text in texts]
        self._learn(set().union(*(words for words in pieces if words is not None)))
        found = self.words.__getitem__
        whole = iter(self._library_ids([text for text, words in zip(texts, pieces, strict=True) if words is None]))
        return [b"".join(map(found, words)) if words is not None else next(whole).tobytes() for words in pieces]

    def _learn(self, met: set[str]) -> None:
        if len(self.words) > self.remembered:
            self.older, self.words = self.words, {}
        met -= self.words.keys()
        again = met & self.older.keys()
        self.words.update((word, self.older[word]) for word in again)
        need = list(met - again)
        together = [word for word in need if MARK not in word and word]
        for start in range(0, len(together), 4096):
            some = together[start : start + 4096]
            ids = self._library_ids([f" {MARK} ".join(some)])[0]
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) != len(some) - 1:
                self.words.update((word, part.tobytes()) for word, part in zip(some, self._library_ids(some), strict=True))
                continue
            packed = ids.tobytes()
            starts, stops = [0, *(4 * (ends + 1)).tolist()], [*(4 * ends).tolist(), len(packed)]
            self.words.update(zip(some, [packed[a:b] for a, b in zip(starts, stops, strict=True)], strict=True))
        alone = [word for word in need if MARK in word or not word]
        self.words.update((word, part.tobytes()) for word, part in zip(alone, self._library_ids(alone), strict=True))

    def _library_ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, dtype="<u4") for e in encoded]


def _ignores_white_space(rules: dict) -> bool:
    before = rules.get("pre_tokenizer") or {}
    first = (before.get("pretokenizers") or [before])[0]
    kinds = [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers", [])]
    return (
        first.get("type") == "Split"
        and (first.get("pattern") or {}).get("Regex") == WORD_RULE
        and first.get("behavior") == "Removed"
        and bool(first.get("invert"))
        and kinds == ["NFC", "Replace", "Lowercase"]
        and not rules.get("truncation")
        and not rules.get("padding")
    )


_ENCODERS: dict[str, TextEncoder] = {}


def encoder_for(path: str) -> TextEncoder:
    """One encoder per worker process and file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def narrow(ids: bytes, width: int) -> bytes:
    """32-bit ids in ``width`` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def widen(ids: bytes, width: int) -> bytes:
    """The reverse of :func:`narrow`."""
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
