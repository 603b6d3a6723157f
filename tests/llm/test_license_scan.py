from __future__ import annotations

import numpy as np
import pytest

from tests.llm.helpers import documents, syllables, words_of
from tillstream.llm.license_scan import NOTICES, PHRASES, _best, normalised, scan_licenses


def brute(text):
    words = words_of(text)
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [p for p, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


def test_exact_phrases_equal_brute_force(spark):
    long = " ".join(syllables(1, 20_000)) + " MIT-License " + " ".join(syllables(2, 20_000))
    texts = [
        None, "", "...", "MIT License", "the mit\nlicense, MIT  LICENSE", "mit licenses", "xmit license", "émit license",
        "gnu General (Public) license cc-by cc by", "cc by cc by cc", "Apache\tLicense apache license2", "mit", "license mit",
        "ccc by", "cc bye", long, "mit license", "mit license",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "cc by"), (3, "twice")]
    got = scan_licenses(documents(spark, rows, "n_words labels found spans")).collect()
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1:]))
    mine = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key)
    assert mine == sorted(((d, *brute(t)) for d, t in rows), key=key)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score == 1.0) if r.n_base else 0 <= r.score < 1


def test_notices_with_errors(spark):
    texts = {
        1: "Released under teh MIT License.",  # letters swapped: two edits
        2: "a b\nReleased undr the MIT Licens. c",
        3: "licenced under the apache licence, version 2.0",
        4: "Mozila Public License",
        5: "released among many other things",
        6: "mozilla was a public licence office" + " word" * 50,
        7: "Licensed under CC BY-NC 4.0",
        8: "released under the m\x00it license",
    }
    got = {r.doc_id: r for r in scan_licenses(documents(spark, list(texts.items()))).collect()}
    assert [got[i].labels for i in range(1, 8)] == ["mit", "mit", "apache", "mpl", "", "", "cc-by,cc-by-nc"]
    assert got[1].n_base == 1 and got[2].n_base == 0 and 0.8 < got[2].score < 1
    span = got[2].spans[0]
    assert (span.label, span.first_word, span.last_word, span.edits) == ("mit", 2, 6, 2)
    assert span.text == "released undr the mit licens"
    assert got[7].spans[0].edits == 0 and got[7].score == 1.0


def test_every_single_edit_outside_the_name_is_found(spark):
    notice = NOTICES[0]
    name = range(notice.text.index(" mit "), notice.text.index(" mit ") + 5)
    places = [i for i in range(len(notice.text)) if i not in name]
    variants = [notice.text[:i] + "q" + notice.text[i + 1 :] for i in places if notice.text[i] != " "]
    variants += [notice.text[:i] + notice.text[i + 1 :] for i in places[1:-1]]
    rows = list(enumerate(f"some words {v} and more" for v in variants))
    got = scan_licenses(documents(spark, rows)).collect()
    assert [r.doc_id for r in got if "mit" not in r.labels] == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def named(run, names):
    """All names in order; longer ones with one edit behind the first letter."""
    words, at = run.split(), 0
    for name in names:
        fits = [w == name or len(name) > 3 and w[0] == name[0] and edits(w, name) == 1 for w in words[at:]]
        if True not in fits:
            return False
        at += fits.index(True) + 1
    return True


@pytest.mark.parametrize(
    "text,labels",
    [
        ("Licensed under the MPL license", "mpl"),
        ("released under the NIST license", ""),
        ("licensed under the ms license", ""),
        ("Licensed under CC BY-ND 4.0", "cc-by,cc-by-nd"),
        ("licensed under cc by sb 4 0", "cc-by"),
        ("released undr the mit licence", "mit"),
        ("mozila public license", "mpl"),
        ("ozilla public license", ""),
        ("eclpse public license", "epl"),
        ("released under the mitt license", ""),
    ],
)
def test_names_of_other_licenses(spark, text, labels):
    assert scanned(spark, [text])[1][0][0] == labels


def test_no_notice_is_taken_for_another(spark):
    _, marks = scanned(spark, [n.text for n in NOTICES])
    for notice, (labels, _) in zip(NOTICES, marks, strict=True):
        base = brute(notice.text)[-1]
        assert set(labels.split(",")) == {notice.label, *filter(None, base.split(","))}


def notices_by_hand(text):
    """All runs of words that are near enough to a notice, and the nearest of those that overlap."""
    words, found = words_of(text), []
    for n in NOTICES:
        for i in range(len(words)):
            for k in range(i, len(words)):
                run = " ".join(words[i : k + 1])
                if abs(len(run) - len(n.text)) <= n.errors and (e := edits(run, n.text)) <= n.errors and (not e or named(run, n.names)):
                    found.append({"label": n.label, "first_word": i, "last_word": k, "edits": e, "text": run})
    return [(s["label"], s["first_word"], s["last_word"], s["edits"], s["text"]) for s in _best(found)]


def scanned(spark, texts):
    got = scan_licenses(documents(spark, list(enumerate(texts))).coalesce(1)).collect()
    return [[tuple(s) for s in r.spans] for r in sorted(got)], [(r.labels, r.score) for r in sorted(got)]


def test_neighbours_do_not_matter(spark):
    worse, better = "mozila public license", "mozilla public license"
    texts = [worse, better, "some words", worse, "redistribution and use in sorce and binary forms", worse, better]
    spans, marks = scanned(spark, texts)
    assert spans == [notices_by_hand(t) for t in texts]
    assert [s[0][3] for s in spans if s] == [1, 0, 1, 1, 1, 0]
    assert marks[0] == marks[3] == marks[5] == ("mpl", 1 - 1 / 22)


def test_repeated_notices_are_all_found(spark):
    import random

    draw = random.Random(6)
    texts = ["mozila public license mozilla public license", "mozila public license x mozilla public licens mozilla public license"]
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(1, 4)):
            n = draw.choice(NOTICES)
            copy = list(n.text)
            for _ in range(draw.randint(0, n.errors)):
                at = draw.randrange(1, len(copy))
                copy[at : at + 1] = draw.choice([[], ["q"], [copy[at], "q"], [" "]])
            parts += ["".join(copy)] * draw.randint(1, 2) + draw.sample(["the", "and use", "license", ""], 1)
        texts.append(" ".join(parts))
    spans, _ = scanned(spark, texts)
    assert [len(s) for s in spans[:2]] == [2, 3]
    assert spans == [notices_by_hand(t) for t in texts]


def test_normalised_block():
    texts = [" A-b  c.", "", "..", "x"]
    raw = [t.encode() for t in texts]
    found, starts, lines = normalised(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]))
    assert [t.strip() for t in found.decode().split("\n")] == ["a b c", "", "", "x", ""]
    assert [chr(found[s]) for s in starts] == ["a", "b", "c", "x"]
    assert lines[-1] == len(found)


def test_empty_table(spark):
    assert scan_licenses(documents(spark, [])).collect() == []
