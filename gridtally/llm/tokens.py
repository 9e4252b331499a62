"""Byte-level BPE ids of whole texts, with a cache of the words between single spaces and line feeds."""

from __future__ import annotations

import base64
import functools
import os
import re
import sys
from array import array

#: Words kept per Python worker, some 200 bytes each, and how long they may be; frequent ones come early, later ones are encoded
#: each time.  A worker keeps them for as long as it lives, also while it works for other operators.
CACHED_PIECES, CACHED_CHARS = 300_000, 32


#: White space that doesn't leave every line feed and the word after every space to itself: a run that ends in neither of both,
#: has three, or ends the text.
_RUNS = re.compile(r"[^\S \n]|  | \n|\n\n[ \n]|\n\n\Z| \Z")


class Encoder:
    """ids as the ``tokenizers`` library gives them, without added special tokens, as little-endian uint32 bytes.

    The pre-tokeniser joins a single space to what follows it and leaves a line feed between words alone, so that a text falls
    apart before both, and the words repeat.  Texts with other white space are encoded whole, and so are, unless ``plain``,
    those that may hold special tokens, which ``plain`` takes for ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as the machine has them, which must be little-endian and 32 bits")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), plain
        self.tokenizer.encode_special_tokens = plain
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self.ranks = self._ranks(path)
        #: Word after a space, or from a line feed on -> ids with that space or line feed.
        self.words: dict[str, bytes] = {"\n": array("I", [self.line_feed]).tobytes()}

    def _ranks(self, path: str):
        """The same vocabulary for ``tiktoken``, if it lies beside the file: several times as fast on new pieces."""
        beside = path.removesuffix(".json") + ".tiktoken"
        if not os.path.exists(beside):
            return None
        import public_tokenizers
        import tiktoken

        with open(beside, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """ids of each word with the space or line feed before it; encoded as lines of one text, which fall apart again."""
        lines = [w[1:] if w[0] == "\n" else " " + w for w in words]
        if not self.ranks:
            ids = self._encode(lines)
        else:
            numbers = self.ranks.encode_ordinary("\n".join([*lines, ""]))
            data, start, ids = array("I", numbers).tobytes(), 0, []
            for end in [i for i, x in enumerate(numbers) if x == self.line_feed]:
                ids.append(data[4 * start:4 * end])
                start = end + 1
        before = self.words["\n"]
        return [before + i if w[0] == "\n" else i for w, i in zip(words, ids, strict=True)]

    def many(self, texts: list[str]) -> list[bytes]:
        """ids of each text; the words that are not cached are encoded together."""
        known = self.words
        cut = [self._cut(t) for t in texts]
        new = list(dict.fromkeys(w for words in cut if words for w in words if w not in known))
        ids = dict(zip(new, self._encode_words(new), strict=True))
        for w in new[:max(0, CACHED_PIECES - len(known))]:
            if len(w) <= CACHED_CHARS:
                known[w] = ids[w]
        whole = iter(self._encode([t for t, words in zip(texts, cut, strict=True) if words is None]))
        out = []
        for text, words in zip(texts, cut, strict=True):
            found = next(whole) if words is None else b"".join([known.get(w) or ids[w] for w in words])
            # Four bytes are the line feed that was put before the text.
            out.append(found[4:] if words and text[0] != " " else found)
        return out

    def _cut(self, text: str) -> list[str] | None:
        """The words of a text, the first one as after a line feed if no space stands before it; None if it can't be cut."""
        if _RUNS.search(text) or not self.plain and "<|" in text:
            return None
        after = text if text.startswith(" ") else "\n" + text
        return after.replace("\n", " \n").split(" ")[1:] if text else []


@functools.lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path, plain)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
