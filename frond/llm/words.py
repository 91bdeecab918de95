"""Words of a text, as the shared definition has them."""

from __future__ import annotations

import re

_TAG = re.compile(r"</?[^\W\d_][^<>]*>")
_SOFT = re.compile("[\u00ad\u200b]+")
_BROKEN = re.compile(r"-(?:\r\n|\n)")
_WORD = re.compile(r"[^\W_]+")
_FORM = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")

#: Share of capitals inside sentences beyond which a language writes its nouns so.
NOUNS = 0.15


def words(text: str | None) -> list[str]:
    """Tags, soft hyphens, zero-width spaces and line-end hyphens go; then the runs of letters and digits.

    Null has none. Lower-casing comes before cutting, so a letter whose lower case brings a mark
    along is cut there.
    """
    if not text:
        return []
    return _WORD.findall(_plain(text).lower())


def _plain(text: str) -> str:
    if "<" in text:
        text = _TAG.sub("", text)
    if "\u00ad" in text or "\u200b" in text:
        text = _SOFT.sub("", text)
    if "-" in text:
        text = _BROKEN.sub("", text)
    return text


def forms(text: str | None) -> list[str]:
    """Words by form: numbers with their decimals, cut from letters; lower-cased, with ^ before a name.

    A name has a capital and stands inside a sentence, or elsewhere in the text if it does so once.
    Where more than NOUNS of the words inside sentences have one, as in German, a capital says
    nothing and no word is a name by form.
    """
    if not text:
        return []
    out, heads, names, start = [], [], set(), True
    inside = capitals = 0
    for w in _FORM.findall(_plain(text)):
        if w in ".!?:\n":
            start = True
            continue
        low = w.lower()
        if w[0].isupper():
            if start:
                heads.append(len(out))
            else:
                names.add(low)
                low = "^" + low
                capitals += 1
        inside += not start
        out.append(low)
        start = False
    if inside >= 20 and capitals > NOUNS * inside:
        return [w.lstrip("^") for w in out]
    for i in heads:
        if out[i] in names:
            out[i] = "^" + out[i]
    return out
