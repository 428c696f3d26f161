"""A SentencePiece model file as the operators need it: pieces, and where no piece crosses.

A segmentation of a text splits wherever no vocabulary piece can span two
neighbouring characters.  ``chunks`` cuts at such places only, so encoding the
chunks one by one is the same as encoding the text, and repeated chunks can be
looked up instead of being encoded again.  The cut rules are checked against
every piece of the model when it is loaded; a model they don't fit is an error.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

SPACE = "▁"
#: Cut before every run of spaces and around line feeds.
COARSE = re.compile(r" *[^ \n]+| +|\n")
#: Cut also after letters that signs follow, and around digits.
FINE = re.compile(r" *[^ \n\w]*[^\W\d_]+| *[^ \n\w]+| *[\d_]+| +|\n")
#: Longer chunks are encoded one by one.
KEEP_CHARS = 48
#: A per-process table with more entries than this is cut to what is in use, so memory stays bounded.
TABLE_ENTRIES = 250_000


class Vocabulary:
    def __init__(self, model_path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        p, size = self.processor, self.processor.get_piece_size()
        self.piece_of = [p.id_to_piece(i) for i in range(size)]
        self.byte_ids = [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.text_of = [x.replace(SPACE, " ") for x in self.piece_of]
        for b in range(128):
            self.text_of[self.byte_ids[b]] = chr(b)
        self.high_bytes = frozenset(self.byte_ids[128:])
        special = {i for i in range(size) if p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i)}
        self.id_of = {x.replace(SPACE, " "): i for i, x in enumerate(self.piece_of) if i not in special}
        self.score_of = {x: p.get_score(i) for x, i in self.id_of.items()}
        self.longest = max(map(len, self.id_of))
        odd = [x for x in self.id_of if COARSE.findall(x) != [x]]
        if odd:
            raise ValueError(f"pieces that cross a word boundary, such as {odd[:3]}")
        #: A text with one of these characters is cut by the coarse rule.
        self.sticky = []
        crossed = [x for x in self.id_of if FINE.findall(x) != [x]]
        while crossed:  # the fewest characters, so that few texts are concerned
            counts = Counter(c for x in crossed for c in set(x) if c != " ")
            self.sticky.append(max(counts, key=lambda c: (counts[c], c)))
            crossed = [x for x in crossed if self.sticky[-1] not in x]

    def chunks(self, text: str, fine: bool = True) -> list[str]:
        """Parts of the text with the leading space that the model adds; none for an empty text.

        U+2581 is the model's own sign for a space and is read as one.
        """
        if not text:
            return []
        text = " " + text.replace(SPACE, " ")
        if fine and not any(c in text for c in self.sticky):
            return FINE.findall(text)
        return COARSE.findall(text)

    def library_ids(self, chunks: list[str]) -> list[list[int]]:
        """The library's ids of each chunk (a line feed in front keeps it from adding its own space)."""
        return [ids[2:] for ids in self.processor.encode(["\n" + c for c in chunks], num_threads=1)]

    def decode(self, ids: list[int]) -> str:
        """The text of a sequence of ids, without the leading space; bad byte runs become U+FFFD."""
        if self.high_bytes.isdisjoint(ids):
            text = "".join(map(self.text_of.__getitem__, ids))
        else:
            out, pending = [], bytearray()
            for i in ids:
                b = self.byte_of.get(i)
                if b is not None:
                    pending.append(b)
                    continue
                if pending:
                    out.append(pending.decode("utf-8", "replace"))
                    pending.clear()
                out.append(self.text_of[i])
            out.append(pending.decode("utf-8", "replace"))
            text = "".join(out)
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=4)
def vocabulary(model_path: str) -> Vocabulary:
    """The vocabulary, loaded once in each process."""
    return Vocabulary(model_path)
