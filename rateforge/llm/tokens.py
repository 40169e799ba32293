"""Token ids of whole texts from a vocabulary file of the ``tokenizers`` library.

A byte-level BPE merges inside pre-tokens only, and the pre-tokenizer always
starts a new pre-token at a single space between two other characters. A text
is therefore cut at such spaces and each piece is encoded once per worker and
kept in a bounded cache; the ids are those of encoding the text at once.

Most pieces are one pre-token, a run of letters. Where a vocabulary numbers its
tokens in the order of their merges, such a piece is merged by ``tiktoken``
with the ranks that the ``tokenizers`` file gives, at a quarter of the time of
a ``tokenizers`` call; every other piece goes through ``tokenizers``.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DEFAULT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces a worker keeps; the cache starts anew beyond it.
CACHE_ENTRIES = 500_000
#: Longer pieces are encoded each time.
CACHED_CHARS = 48

_CUT = re.compile(r"(?<=\S)(?= \S)")
#: White space other than the space and the line break.
_OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_TAIL = re.compile(r"([^\W\d_]+)([.,;:!?*#$%&|<>]+)")


def _uneven(text: str) -> bool:
    """Whether white space is more than single spaces and line breaks between other characters."""
    return (
        "  " in text
        or "\n\n" in text
        or " \n" in text
        or "\n " in text
        or text[0] in " \n"
        or text[-1] in " \n"
        or any(c in text for c in _OTHER_SPACES)
    )


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in a byte-level BPE vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    others = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(others)}


def _ranks(tokenizer: Tokenizer) -> dict[bytes, int] | None:
    """The bytes of each token with its id, if ids follow the order of merges."""
    model = json.loads(tokenizer.to_str())["model"]
    vocabulary = model["vocab"]
    first = len(vocabulary) - len(model["merges"])
    for i, pair in enumerate(model["merges"]):
        if vocabulary.get("".join(pair if isinstance(pair, list) else pair.split(" "))) not in (i + 256, i + first):
            return None
    byte_of = {c: b for b, c in _byte_alphabet().items()}
    special = set(t.content for t in tokenizer.get_added_tokens_decoder().values())
    if any(c not in byte_of for token in vocabulary if token not in special for c in token):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}


class TextEncoder:
    """Ids of a text as little-endian bytes, ``width`` 2 or 4 each.

    ``plain_specials``: the strings of special tokens in a text are ordinary
    text; otherwise they become the special ids, the library's default.
    """

    def __init__(self, path: str = DEFAULT_TOKENIZER, width: int = 4, plain_specials: bool = False) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.specials = [] if plain_specials else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = {2: "H", 4: "I"}[width]
        ranks = _ranks(self.tokenizer)
        self.merge = None
        if ranks:
            self.merge = tiktoken.Encoding("letters", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.pieces: dict[str, bytes] = _Pieces(self, "")
        self.spaced: dict[str, bytes] = _Pieces(self, " ")

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if _uneven(text):
            return b"".join(map(self.pieces.__getitem__, _CUT.split(text)))
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(self.pieces[first] + b"".join(map(self.spaced.__getitem__, rest)))
        return self.pieces["\n"].join(lines)


class _Pieces(dict):
    """Ids of pieces; the key is the piece without ``lead``, the space before it."""

    def __init__(self, owner: TextEncoder, lead: str) -> None:
        super().__init__()
        self.owner, self.lead = owner, lead

    def __missing__(self, word: str) -> bytes:
        owner = self.owner
        if owner.merge and word.isalpha():  # one pre-token
            ids = array(owner.code, owner.merge((self.lead + word).encode())).tobytes()
        elif (m := _TAIL.fullmatch(word)) and m[1].isalpha():  # letters, then symbols: two pre-tokens
            ids = self[m[1]] + owner.pieces[m[2]]
        else:
            ids = array(owner.code, owner.tokenizer.encode(self.lead + word, add_special_tokens=False).ids).tobytes()
        if len(word) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=4)
def encoder(path: str = DEFAULT_TOKENIZER, width: int = 4, plain_specials: bool = False) -> TextEncoder:
    """The worker's encoder; its cache lasts over batches and tasks."""
    return TextEncoder(path, width, plain_specials)
