"""Symbols, ranks and chunks of a SentencePiece BPE model file, read through its library."""

from __future__ import annotations

import re

MARK = "▁"  # the model's white-space marker


class PieceModel:
    """What the two operators on such a model share: the pieces with their merge ranks (lower merges
    first) and the rule that cuts a marked text into chunks that no piece crosses."""

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        self.byte_fallback = any(sp.is_byte(i) for i in range(sp.get_piece_size()))
        # the text as the model sees it must be the text itself with spaces marked and one mark in front
        probe = f"a  bﬁ c{MARK}d\t\n "
        if "".join(sp.id_to_piece(i) for i in sp.encode("a  b c ")) != f"{MARK}a{MARK}{MARK}b{MARK}c{MARK}" \
                or sp.decode(sp.encode(probe)) != probe.replace(MARK, " "):
            raise ValueError("the model normalises its input; chunk tables need one that does not")
        pairs = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        if any(a != MARK and b == MARK for a, b in pairs):
            raise ValueError("a piece crosses a white-space marker")
        inner = rf"[^{MARK}\n]"
        if any("\n" in pair for pair in pairs):  # a line break is joined to its neighbours
            self._chunk = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
        elif any(a.isascii() and a.isalpha() and b in "!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~" for a, b in pairs):
            self._chunk = re.compile(rf"{MARK}*{inner}+|{MARK}+|\n")
        else:  # nor does any piece join an ASCII letter to one of these marks after it
            self._chunk = re.compile(
                rf"{MARK}*{inner}*?[A-Za-z](?=[!\"#$%&()*+,./:;<=>?@\[\\\]^_`{{|}}~\n]|$)|{MARK}*{inner}+|{MARK}+|\n")

    def chunks(self, text: str) -> list[str]:
        """Consecutive parts of the marked text; every piece of the text lies inside one of them."""
        return self._chunk.findall(MARK + text.replace(" ", MARK)) if text else []
