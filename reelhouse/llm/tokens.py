"""Token ids of whole texts by a public tokenizer file, inside tasks."""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import struct
from collections.abc import Callable, Sequence

import numpy as np

#: Pieces whose ids an encoder remembers, and the longest piece that it does. Worker processes keep them from task to task.
REMEMBERED, LONGEST = 400_000, 48

#: Letters that stay one letter when lower-cased; U+0130 becomes two, of which the second belongs to a stop behind it.
_LETTER = "a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
#: A word before white space or a stop; one line end; stops before white space; else all up to the next white space.
_PIECES = re.compile(rf" ?[{_LETTER}]+(?![^ \n.,!?;:])|\n(?![ \n])|[.,!?;:]+(?![^ \n])|[ \n]*[^ \n]+|[ \n]+")
#: The same for a tokenizer that drops white space: the pieces alone.
_BARE_PIECES = re.compile(rf"[{_LETTER}]+(?![^ \n.,!?;:])|[.,!?;:]+(?![^ \n])|[^ \n]+")
_WORD = re.compile(rf" ?[{_LETTER}]+")
#: White space but for blank and line end, and characters that some take for it. Looked up one by one, which is faster than a pattern.
_OTHER_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"


def token_file(name: str) -> str:
    """Place of a public tokenizer file; looked up where it is used, so that every executor finds its own."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def version(name: str) -> str:
    """Digest of the tokenizer file."""
    with open(token_file(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _splits_at_space(tokenizer) -> bool:
    """Whether the ids of a text are those of its pieces, cut in front of white space that follows other characters.

    So for the byte-level splitter without a normaliser, and for splitters that remove white space; both look at nothing
    to the left of a match, and white space ends every match.
    """
    from tokenizers import pre_tokenizers

    pre = tokenizer.pre_tokenizer
    if isinstance(pre, pre_tokenizers.ByteLevel):
        return tokenizer.normalizer is None and not pre.add_prefix_space and pre.use_regex
    state = pre.__getstate__().decode() if isinstance(pre, pre_tokenizers.Sequence) else ""
    return '"behavior":"Removed","invert":true' in state.replace(" ", "") and "[^\\\\s" in state


def _keeps_space(tokenizer) -> bool:
    from tokenizers import pre_tokenizers

    return isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)


def _bytes_shown() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(other)}


def _model_form(tokenizer) -> Callable[[str], str] | None:
    """What a byte-level tokenizer's model is given for a word of _LETTER, which no splitter cuts; None if its steps aren't known.

    Composed letters are left alone by NFC, and so are words by what replaces white space alone. A blank in front is part of the word
    where white space is kept.
    """
    shown = _bytes_shown()
    state = json.loads(tokenizer.pre_tokenizer.__getstate__())
    steps = json.loads(tokenizer.normalizer.__getstate__()) if tokenizer.normalizer is not None else {"type": "Sequence", "normalizers": []}
    steps = steps["normalizers"] if steps["type"] == "Sequence" else [steps]
    if any(x["type"] not in ("NFC", "Lowercase", "Replace") or x.get("pattern", {"Regex": "\\s+"}) != {"Regex": "\\s+"} for x in steps):
        return None
    if state["type"] == "Sequence":
        split, *behind = state["pretokenizers"]
        whole = split["type"] == "Split" and "|[\\p{L}]+|" in split["pattern"].get("Regex", "")
        if not whole or [(x["type"], x.get("add_prefix_space"), x.get("use_regex")) for x in behind] != [("ByteLevel", False, False)]:
            return None
    lower = any(x["type"] == "Lowercase" for x in steps)

    def form(word: str) -> str:
        word = word.lower() if lower else word
        if word.isascii():  # letters stand for themselves
            return shown[32] + word[1:] if word[0] == " " else word
        return word.encode().decode("latin-1").translate(shown)

    return form


class Encoder:
    """Ids as the library gives them for the whole text, without added special tokens.

    Where the tokenizer allows it, a text is cut into pieces at spaces, line ends and stops behind a word, and the library encodes each
    piece once; words go to its model at once, since no step before that cuts them. Texts with other white space, or with the
    string of a special token, are encoded in one go.
    """

    def __init__(self, name: str):
        self.model = None
        if name.endswith(".model"):
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=token_file(name))
            self.cut, self.size = False, self.model.vocab_size()
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(token_file(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cut, self.size = _splits_at_space(self.tokenizer), self.tokenizer.get_vocab_size()
        self.pieces = _PIECES if _keeps_space(self.tokenizer) else _BARE_PIECES
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.last_special = self.tokenizer.token_to_id(self.special[-1]) if self.special else None
        self.form = _model_form(self.tokenizer) if self.cut else None
        self.model_of_words = self.tokenizer.model
        self.known: dict[str, bytes] = {}

    def _library(self, texts: Sequence[str]) -> list[bytes]:
        if self.model is not None:
            return [np.asarray(ids, dtype="<u4").tobytes() for ids in self.model.encode(list(texts), num_threads=1)]
        coded = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in coded]

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.cut or any(c in text for c in _OTHER_SPACE) or any(s in text for s in self.special):
            return self._library([text])[0]
        pieces = self.pieces.findall(text)
        found = list(map(self.known.get, pieces))
        if None in found:
            learnt = self._learnt({piece for piece, ids in zip(pieces, found) if ids is None})
            found = [learnt[piece] if ids is None else ids for piece, ids in zip(pieces, found)]
        return b"".join(found)

    def _learnt(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of new pieces, from now on remembered. When there are too many, those met first stay, which are the frequent ones."""
        learnt, tokenize = {}, self.model_of_words.tokenize
        if self.form is not None:
            for piece in filter(_WORD.fullmatch, pieces):
                ids = [t.id for t in tokenize(self.form(piece))]
                learnt[piece] = struct.pack(f"<{len(ids)}I", *ids)
        if rest := [piece for piece in pieces if piece not in learnt]:
            learnt.update(zip(rest, self._together(rest)))
        self.known.update((piece, ids) for piece, ids in learnt.items() if len(piece) <= LONGEST)
        if len(self.known) > REMEMBERED:
            self.known = dict(itertools.islice(self.known.items(), REMEMBERED // 2))
        return learnt

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces in one call, with a special token between them: the library encodes what stands between apart."""
        if len(pieces) == 1 or not self.special:
            return self._library(pieces)
        ids = np.frombuffer(self._library([self.special[-1].join(pieces)])[0], dtype="<u4")
        ends = np.flatnonzero(ids == self.last_special)
        raw, bounds = ids.tobytes(), [0, *(4 * ends + 4).tolist(), 4 * len(ids) + 4]
        return [raw[a : b - 4] for a, b in zip(bounds, bounds[1:])]


@functools.cache
def encoder(name: str) -> Encoder:
    """One per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(name)
