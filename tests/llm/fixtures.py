"""Small documents with the cases every operator has to stand."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    out = []
    for _ in range(n):
        out.append("".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) + pick.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def edited(text: str, every: int, seed: int) -> str:
    pick = random.Random(seed)
    words = text.split(" ")
    for i in range(pick.randrange(every), len(words), every):
        words[i] = f"edit{pick.randrange(10**6)}"
    return " ".join(words)


def documents() -> list[tuple]:
    """(doc_id, text, n_tokens): null and empty texts, a null id, repeated
    rows, exact and near copies, a shared line, odd characters, a long text."""
    base = [prose(i, 120) for i in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(20, base[3]), (21, base[3]), (22, base[3])]
    rows += [(30 + k, edited(base[5], 60, k)) for k in range(6)]
    rows += [(40 + k, "The same first line stands here for all of them.\n" + prose(100 + k, 60)) for k in range(5)]
    rows += [(50, None), (51, ""), (52, " \n\t"), (53, "One."), (54, "one"), (55, "a b c"), (None, base[1]), (None, None)]
    rows += [(0, base[0]), (0, base[0])]
    rows += [(60, "Grüße, ΣΑΣ 中文 ß́ \x1c\x85 it's we'll x''s  'S <|endoftext|> ²Ⅷ \x00 end"), (61, "a" * 3000), (62, prose(7, 6000))]
    return [(i, t, 7) for i, t in rows]


SCHEMA = "doc_id long, text string, n_tokens int"
