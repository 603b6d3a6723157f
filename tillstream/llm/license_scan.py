"""License notices in texts, exact and with a few errors.

Exact phrases are found as words that stand consecutively. Short notices are found with
up to ``errors`` edits: a notice is split into one seed more than that, so one seed of
any match is untouched (pigeonhole). The seeds are searched exactly; for every run of words
that can hold a hit, the regex library's bounded-error matching decides alone, and gives the
edits. Of notices that overlap, the nearest counts. The words that tell a license from others
must be there: no edit may turn one license's name into another's.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import LOWER, PUNCTUATION, blocks

# fixed values: the phrases whose places are counted, and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Notice:
    """A notice as lower-case words with single spaces between, and its label."""

    text: str
    label: str
    # what tells it from other licenses; words of the text, in its order
    names: tuple[str, ...] = ()

    @property
    def errors(self) -> int:
        """One edit for each twelve characters, one to four."""
        return min(4, max(1, len(self.text) // 12))

    def seeds(self) -> list[tuple[int, bytes]]:
        """Offsets and bytes of ``errors + 1`` pieces of about equal length."""
        raw, pieces = self.text.encode(), self.errors + 1
        cuts = [len(raw) * k // pieces for k in range(pieces + 1)]
        return [(a, raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _named(word: str, name: str) -> bool:
    """Whether ``word`` is ``name``; if that has over three letters, with one edit behind the first."""
    if len(name) <= 3 or word == name or not word or word[0] != name[0]:
        return word == name
    k = next((i for i, (a, b) in enumerate(zip(word, name)) if a != b), min(len(word), len(name)))
    rest, own = word[k:], name[k:]
    return rest[1:] == own[1:] or rest == own[1:] or rest[1:] == own


def told_apart(run: str, notice: Notice) -> bool:
    """Whether all names of ``notice`` stand in a run of words, in order."""
    words = iter(run.split(" "))
    return all(any(_named(word, name) for word in words) for name in notice.names)


# fixed values: short notices that are searched with errors
NOTICES = (
    Notice("released under the mit license", "mit", ("mit",)),
    Notice("licensed under the mit license", "mit", ("mit",)),
    Notice("licensed under the apache license version 2 0", "apache", ("apache",)),
    Notice("released under the apache license", "apache", ("apache",)),
    Notice("licensed under the gnu general public license", "gpl", ("gnu", "general")),
    Notice("released under the gnu general public license", "gpl", ("gnu", "general")),
    Notice("licensed under the gpl license", "gpl", ("gpl",)),
    Notice("released under the gpl license", "gpl", ("gpl",)),
    Notice("gnu lesser general public license", "lgpl", ("gnu", "lesser")),
    Notice("licensed under the lgpl license", "lgpl", ("lgpl",)),
    Notice("gnu affero general public license", "agpl", ("gnu", "affero")),
    Notice("licensed under the agpl license", "agpl", ("agpl",)),
    Notice("licensed under cc by 4 0", "cc-by", ("cc", "by")),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", ("cc", "by", "nc")),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", ("cc", "by", "sa")),
    Notice("licensed under cc by nd 4 0", "cc-by-nd", ("cc", "by", "nd")),
    Notice("licensed under cc by nc sa 4 0", "cc-by-nc-sa", ("cc", "by", "nc", "sa")),
    Notice("licensed under cc by nc nd 4 0", "cc-by-nc-nd", ("cc", "by", "nc", "nd")),
    Notice("creative commons attribution", "cc-by", ("creative", "commons", "attribution")),
    Notice("mozilla public license", "mpl", ("mozilla",)),
    Notice("licensed under the mpl license", "mpl", ("mpl",)),
    Notice("released under the mpl license", "mpl", ("mpl",)),
    Notice("eclipse public license", "epl", ("eclipse",)),
    Notice("licensed under the epl license", "epl", ("epl",)),
    Notice("redistribution and use in source and binary forms", "bsd", ("source", "binary")),
    Notice("licensed under the bsd 3 clause license", "bsd", ("bsd",)),
    Notice("licensed under the bsd license", "bsd", ("bsd",)),
    Notice("released under the bsd license", "bsd", ("bsd",)),
    Notice("licensed under the isc license", "isc", ("isc",)),
    Notice("permission to use copy modify and or distribute this software", "isc", ("copy", "modify", "distribute")),
    Notice("free and unencumbered software released into the public domain", "unlicense", ("unencumbered",)),
)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts of a block as lower-case words with one space between, a line feed after each.

    Also returns where each word starts and where each text starts (and the last ends).
    """
    data = LOWER[np.insert(data, offsets[1:], 10)]
    line_ends = offsets[1:] + np.arange(len(offsets) - 1)
    word = ~PUNCTUATION[data]
    keep = word.copy()
    keep[1:] |= word[:-1]
    keep[line_ends] = True
    data[~word] = 32
    data[line_ends] = 10
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    place = np.cumsum(keep) - 1
    texts = np.concatenate([[0], place[line_ends] + 1])
    return data[keep].tobytes(), place[starts], texts


def _hits(raw: bytes, piece: bytes) -> Iterator[int]:
    at = raw.find(piece)
    while at >= 0:
        yield at
        at = raw.find(piece, at + 1)


def _whole_words(raw: bytes, lo: int, hi: int) -> bool:
    return (lo == 0 or raw[lo - 1] in b" \n") and (hi >= len(raw) or raw[hi] in b" \n")


def _fuzzy(raw: bytes, notice: Notice, pattern: regex.Pattern) -> Iterator[tuple[int, int, int]]:
    """Start, end and edits of all runs of words of one text that are a notice with errors."""
    size, slack = len(notice.text.encode()), notice.errors
    starts = {
        lo
        for off, seed in notice.seeds()
        for at in _hits(raw, seed)
        for lo in range(max(at - off - slack, 0), min(at - off + slack, at) + 1)
        if raw[lo] not in b" \n" and (lo == 0 or raw[lo - 1] in b" \n")
    }
    for lo in sorted(starts):
        for hi in range(lo + size - slack, min(lo + size + slack, len(raw)) + 1):
            if raw[hi - 1] not in b" \n" and _whole_words(raw, lo, hi) and b"\n" not in raw[lo:hi]:
                m = pattern.fullmatch(raw, lo, hi)
                if m:
                    yield lo, hi, sum(m.fuzzy_counts)


def _best(spans: list[dict]) -> list[dict]:
    """Of notices that overlap the one with the fewest edits, then the longest; in order."""
    chosen: list[dict] = []  # in order, without overlaps
    for s in sorted(spans, key=lambda s: (s["edits"], -len(s["text"]), s["first_word"], s["label"])):
        at = bisect_left(chosen, s["first_word"], key=lambda c: c["first_word"])
        after = at == len(chosen) or s["last_word"] < chosen[at]["first_word"]
        if after and (not at or chosen[at - 1]["last_word"] < s["first_word"]):
            chosen.insert(at, s)
    return chosen


_SPANS = pa.list_(
    pa.struct(
        [
            ("label", pa.string()),
            ("first_word", pa.int64()),
            ("last_word", pa.int64()),
            ("edits", pa.int64()),
            ("text", pa.string()),
        ]
    )
)
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, spans array<struct<label:string, first_word:long, "
    "last_word:long, edits:long, text:string>>"
)


def _scan(notices: tuple[Notice, ...]):
    patterns = [
        regex.compile(b"(?b)(?:" + regex.escape(n.text.encode()) + b"){e<=%d}" % n.errors) for n in notices
    ]

    def run(texts: pa.Array) -> pa.Array:
        columns: list[list] = [[] for _ in range(8)]
        batch = pa.record_batch([texts], names=["text"])
        for _, data, offsets in blocks(iter([batch]), "text"):
            raw, starts, lines = normalised(data, offsets)
            first = np.searchsorted(starts, lines)
            count = len(lines) - 1
            base: list[list[tuple[int, str]]] = [[] for _ in range(count)]
            spans: list[list[dict]] = [[] for _ in range(count)]
            scores = [0.0] * count
            for phrase, label in PHRASES.items():
                piece = phrase.encode()
                for at in _hits(raw, piece):
                    if _whole_words(raw, at, at + len(piece)):
                        line = int(np.searchsorted(lines, at, "right")) - 1
                        word = int(np.searchsorted(starts, at)) - int(first[line])
                        base[line].append((word, label))
                        scores[line] = 1.0
            for notice, pattern in zip(notices, patterns, strict=True):
                for lo, hi, edits in _fuzzy(raw, notice, pattern):
                    if edits and not told_apart(raw[lo:hi].decode(errors="replace"), notice):
                        continue
                    line = int(np.searchsorted(lines, lo, "right")) - 1
                    lead = int(first[line])
                    spans[line].append(
                        {
                            "label": notice.label,
                            "first_word": int(np.searchsorted(starts, lo, "right")) - 1 - lead,
                            "last_word": int(np.searchsorted(starts, hi)) - 1 - lead,
                            "edits": edits,
                            "text": raw[lo:hi].decode(errors="replace"),
                        }
                    )
                    spans[line][-1]["score"] = 1 - edits / len(notice.text)
            for i in range(count):
                places = [p for p, _ in base[i]]
                exact = {x for _, x in base[i]}
                found = _best(spans[i])
                values = (
                    int(first[i + 1] - first[i]),
                    len(places),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted(exact)),
                    ",".join(sorted(exact | {s["label"] for s in found})),
                    max([scores[i], *(s.pop("score") for s in found)]),
                    found,
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), _SPANS]
        names = "n_words n_base first_word last_word base_labels labels score spans".split()
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
        )

    return run


def scan_licenses(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: tuple[Notice, ...] = NOTICES
) -> DataFrame:
    """What license phrases and notices each row's whole text holds.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Returns
    ``doc_id``, ``n_words``; ``n_base``, ``first_word``, ``last_word`` of the exact phrases
    (all places; smallest and largest starting word, null if none), their ``base_labels``;
    ``labels`` that also holds those of notices with errors; ``score``, 1 for an exact
    phrase, else 1 less the edits per character of the best notice, else 0; ``spans`` of
    the notices, by words, with their edits and matched words. A null or empty text has no
    words and no labels. Rows are judged alone, so ids may be null or repeat.
    """
    scan = F.arrow_udf(_scan(notices), RESULT)
    return docs.select(
        F.col(id_col).alias("doc_id"), scan(F.coalesce(F.col(text_col), F.lit(""))).alias("found")
    ).select("doc_id", "found.*")
