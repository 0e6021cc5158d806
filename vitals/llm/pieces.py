"""Pieces of a SentencePiece model as a trie, and a text's pre-tokens: its runs
between neighbouring characters that no piece joins.

Byte-pair models carry merge ranks in the place of log-probabilities; by Zipf's
law a piece of rank r scores -ln(r + 2). Characters without a piece of their own
fall back to their bytes, as does the meta symbol itself where a text holds it.
"""

from __future__ import annotations

import math

import numpy as np

META = "▁"
#: stands for a meta symbol of the text itself while it is cut into pre-tokens
_OWN_META = "﷐"


class Pieces:
    """``trie`` maps a character to (trie below, id or -1, score)."""

    def __init__(self, file: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.trie: dict = {}
        self.byte_ids = [-1] * 256
        self.text_of: list[str | bytes] = []
        self.prefix = bool(model.encode("a", out_type=str)[0].startswith(META))
        low = 0.0
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = k
                self.text_of.append(bytes([value]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                self.text_of.append("")
            else:
                score = -math.log(2 - model.get_score(k))
                low = min(low, score)
                self.text_of.append(piece)
                self._add(piece, k, score)
        self.data_of = [x if isinstance(x, bytes) else x.replace(META, " ").encode() for x in self.text_of]
        pieces = [x for x in self.text_of if isinstance(x, str) and x]
        #: class of a character (0: in no piece), and pairs that stand side by side in a piece
        letters = sorted({c for x in pieces for c in x})
        self._class = np.zeros(0x110000, np.uint16)
        self._class[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._joined = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for x in pieces:
            k = self._class[[ord(c) for c in x]]
            self._joined[k[:-1], k[1:]] = True
        #: what a character without a piece scores
        self.missing = low - 10.0

    def _add(self, piece: str, k: int, score: float) -> None:
        level = self.trie
        for c in piece[:-1]:
            level = level.setdefault(c, ({}, -1, 0.0))[0]
        below = level.get(piece[-1], ({},))[0]
        level[piece[-1]] = (below, k, score)

    def units(self, text: str) -> list[str]:
        """The text cut wherever no piece holds the two characters side by side:
        every segmentation has a border there."""
        if not text:
            return []
        text = text.replace(META, _OWN_META).replace(" ", META)
        if self.prefix:
            text = META + text
        k = self._class[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
        cuts = [0, *(np.flatnonzero(~self._joined[k[:-1], k[1:]]) + 1).tolist(), len(text)]
        return [text[i:j] for i, j in zip(cuts, cuts[1:])]

    def bytes_of(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in (META if c == _OWN_META else c).encode("utf-8", "surrogatepass")]

    def decode(self, ids) -> str:
        """The text of ids; byte pieces join to characters."""
        text = b"".join(map(self.data_of.__getitem__, ids)).decode("utf-8", "surrogatepass")
        return text[1:] if self.prefix and text.startswith(" ") else text
