"""Metaphone keys (Philips, 1990) of single words, as an Arrow UDF."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOWELS = set("AEIOU")


def metaphone(word: str) -> str:
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    if not w:
        return ""
    if w[:2] in ("KN", "GN", "PN", "AE", "WR"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out: list[str] = []
    at = lambda i: w[i] if 0 <= i < len(w) else ""
    i = 0
    while i < len(w):
        c, before, after = w[i], at(i - 1), at(i + 1)
        step = 1
        if c == before and c != "C":
            pass
        elif c in _VOWELS:
            if i == 0:
                out.append(c)
        elif c == "B":
            if not (before == "M" and i == len(w) - 1):
                out.append("B")
        elif c == "C":
            if after == "H":
                out.append("K" if before == "S" else "X")
                step = 2
            elif after == "I" and at(i + 2) == "A":
                out.append("X")
            elif after and after in "EIY":
                if before != "S":
                    out.append("S")
            else:
                out.append("K")
        elif c == "D":
            if after == "G" and at(i + 2) and at(i + 2) in "EIY":
                out.append("J")
                step = 2
            else:
                out.append("T")
        elif c == "G":
            if after == "H":
                if at(i + 2) in _VOWELS:
                    out.append("K")
                    step = 2
                else:
                    step = 2
            elif after == "N" and (i + 2 == len(w) or w[i + 1 :] == "NED"):
                pass
            elif after and after in "EIY" and before != "G":
                out.append("J")
            else:
                out.append("K")
        elif c == "H":
            if after in _VOWELS and before not in set("CSPTG"):
                out.append("H")
        elif c == "K":
            if before != "C":
                out.append("K")
        elif c == "P":
            if after == "H":
                out.append("F")
                step = 2
            else:
                out.append("P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            if after == "H":
                out.append("X")
                step = 2
            elif after == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            else:
                out.append("S")
        elif c == "T":
            if after == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            elif after == "H":
                out.append("0")
                step = 2
            elif not (after == "C" and at(i + 2) == "H"):
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            if after in _VOWELS:
                out.append(c)
        elif c == "X":
            out += ["K", "S"]
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
        i += step
    return "".join(out)


def _keys(words: pd.Series) -> pd.Series:
    known = {w: metaphone(w) for w in words.dropna().unique()}
    return words.map(known).fillna("")


def metaphone_key(word: Column) -> Column:
    return F.pandas_udf(_keys, "string")(word)
