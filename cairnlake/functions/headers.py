"""Column names made out of file headers: lower-case identifiers of at most 63 characters, all different."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

LONGEST = 63
_VALID = re.compile(r"[a-z_][a-z0-9_]*")

#: Words and their short forms.
SHORT_FORMS = {
    "address": "addr", "amount": "amt", "application": "app", "average": "avg", "category": "cat", "configuration": "config", "coordinate": "coord",
    "department": "dept", "description": "desc", "estimated": "est", "geometry": "geom", "identification": "id", "identifier": "id", "information": "info",
    "international": "intl", "latitude": "lat", "longitude": "lon", "maximum": "max", "minimum": "min", "number": "num", "organization": "org",
    "percentage": "pct", "quantity": "qty", "reference": "ref", "revenue": "rev", "service": "svc", "telephone": "tel", "transaction": "txn",
}


def unrepeated(name: str) -> str:
    """Each word of an underscored name once, where it first stands."""
    return "_".join(dict.fromkeys(w for w in name.split("_") if w))


def without_inner_vowels(name: str) -> str:
    """Words of more than two letters keep only their first and last letter and the consonants between."""
    return "_".join(w if len(w) <= 2 else w[0] + re.sub("[aeiou]", "", w[1:-1]) + w[-1] for w in name.split("_"))


def _worded(text: str, words: Mapping[str, str]) -> str:
    """Whole words replaced, longer ones first, case ignored."""
    if not words:
        return text
    table = {k.lower(): v for k, v in words.items()}
    either = "|".join(map(re.escape, sorted(table, key=len, reverse=True)))
    return re.sub(rf"\b(?:{either})\b", lambda m: table[m[0].lower()], text, flags=re.IGNORECASE)


def _clean(header: str, at: int, stop: set[str], words: Mapping[str, str]) -> str:
    other = f"col_{at}"
    text = header.strip().lower()
    if not text:
        return other
    parts = re.sub("[^a-z0-9]", "_", _worded(text, words)).split("_")
    name = "_".join(p for p in parts if p and p not in stop) or other
    name = "_" + name if name[0].isdigit() else name
    for shorten in (unrepeated, without_inner_vowels, lambda n: n[:LONGEST].rstrip("_")):
        if len(name) > LONGEST:
            name = shorten(name)
    return name


def normalize(headers: Iterable[str], stop_words: Iterable[str] = (), short_forms: Mapping[str, str] | None = None, expansions: Mapping[str, str] | None = None) -> tuple[dict[str, str], list[str]]:
    """The mapping of headers to names and the names in order.

    ``expansions`` are applied before, ``short_forms`` within; repeated names get the first free suffix _1, _2 and so on, so
    the names are always different; of repeated headers the last gives the mapping.
    """
    headers = list(headers)
    stop, used, names = {w.lower() for w in stop_words}, set(), []
    for at, header in enumerate(headers):
        base = name = _clean(_worded(header or "", expansions or {}), at, stop, short_forms or {})
        n = 0
        while name in used:
            n += 1
            name = base[: LONGEST - len(f"_{n}")] + f"_{n}"
        if not _VALID.fullmatch(name):
            name = f"col_{at}"
        used.add(name)
        names.append(name)
    return dict(zip(headers, names)), names


def shortened(headers: Iterable[str], stop_words: Iterable[str] = ()) -> tuple[dict[str, str], list[str]]:
    """``normalize`` with the usual short forms in place of long words."""
    return normalize(headers, stop_words, SHORT_FORMS)
