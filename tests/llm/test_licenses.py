"""License templates against a search that tries every way through a template."""

from __future__ import annotations

import random
import re

import pytest

from ledgerline.llm.licenses import (
    PHRASES,
    TEMPLATES,
    Automaton,
    covered,
    license_summary,
    parse_template,
    scan_licenses,
    words_of,
)


def ends(parts, words, at):
    """All places where wording for ``parts`` that begins at ``at`` can end."""
    if not parts:
        return {at}
    first, rest = parts[0], parts[1:]
    if isinstance(first, bytes):
        return ends(rest, words, at + 1) if at < len(words) and words[at] == first else set()
    if first[0] == "optional":
        return ends(rest, words, at) | {e for m in ends(first[1], words, at) for e in ends(rest, words, m)}
    return {e for n in range(first[1], first[2] + 1) if at + n <= len(words) for e in ends(rest, words, at + n)}


def brute(text, phrases=PHRASES, templates=TEMPLATES):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    coded = [w.encode() for w in words]
    places = []
    for base, entries in ((True, phrases), (False, templates)):
        for label, markup in entries:
            parts = parse_template(markup)
            for s in range(len(coded)):
                if found := ends(parts, coded, s):
                    places.append((label, base, s, max(found) - s))
    at = [s for _, base, s, _ in places if base]
    inside = {i for _, _, s, n in places for i in range(s, s + n)}
    return (
        len(words), len(at), min(at, default=None), max(at, default=None),
        ",".join(sorted({p[0] for p in places if p[1]})), ",".join(sorted({p[0] for p in places})),
        len(inside) / len(words) if words else 0.0,
    )


NOTICES = [
    "Licensed under the Apache License, Version 2.0.",
    "Released under the MIT License. Released under the terms of the MIT license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0. under a CC-BY-NC licence",
    "under the mit licenses; under the mıt license; underé the mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "files (the 'Software'), to deal in the Software without restriction",
    "permission is hereby granted free of charge to any person obtaining a copy of to deal in it without restriction",
    "UNDER THE MIT LICENSE" * 2,
    "apache license version 2 apache license version 2",
    "under the\x00mit_license",
    "cc by nc" + " x" * 30 + " cc by",
    "redistribution and use in source and binary forms with or without modification are permitted",
    "KELVIN K licensed under the apache software license 2",
]


@pytest.mark.parametrize("text", NOTICES)
def test_notices(spark, text):
    found = license_summary(scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert tuple(found)[1:] == brute(text)


def test_edges(spark, edge_docs, edge_rows):
    found = license_summary(scan_licenses(edge_docs))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(((i, *brute(t)) for i, t in edge_rows), key=str)


def test_empty(spark, no_docs):
    assert license_summary(scan_licenses(no_docs)).count() == 0


def test_random_templates(spark):
    """Random markup over few words, random texts over the same words, several slices."""
    r = random.Random(5)

    def template():
        out = [r.choice("abc")]
        for _ in range(r.randint(0, 5)):
            kind = r.random()
            if kind < 0.5:
                out.append(r.choice("abc"))
            elif kind < 0.75:
                out.append(f"<<beginOptional>>{r.choice('abc')} {r.choice('abc')}<<endOptional>>")
            elif kind < 0.9:
                out.append(f'<<var;name="v";least="{r.randint(0, 1)}";most="{r.randint(1, 3)}">>')
            else:
                out.append(f"<<beginOptional>>b <<beginOptional>>c<<endOptional>> a<<endOptional>>")
        return " ".join(out)

    templates = tuple((f"t{k}", template()) for k in range(12))
    phrases = (("p", "a b"), ("q", "c"))
    texts = [" ".join(r.choice("aabbccd") for _ in range(r.randint(0, 40))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = license_summary(scan_licenses(docs, phrases=phrases, templates=templates))
    assert sorted(tuple(x) for x in found.collect()) == [(k, *brute(t, phrases, templates)) for k, t in enumerate(texts)]


def test_long_text(spark):
    """Places of a text of several megabytes are counted from its first word."""
    text = "x " * 1_500_000 + "under the MIT license " + "y, " * 500_000 + "cc by nc"
    row = license_summary(scan_licenses(spark.createDataFrame([(1, text), (2, "cc by nc")], "doc_id long, text string")))
    one, two = sorted(row.collect())
    assert (one.n_words, one.n_base, one.first_word, one.last_word) == (2_000_007, 2, 1_500_000, 2_000_004)
    assert (two.n_words, two.first_word, two.score) == (3, 0, 1.0)


def test_states_can_be_forgotten(monkeypatch):
    monkeypatch.setattr("ledgerline.llm.licenses.STATES", 2)
    made = Automaton([m for _, m in TEMPLATES])
    for text in NOTICES * 2:
        words = words_of(text)
        for s in range(len(words)):
            want = {k: max(e) - s for k, (_, m) in enumerate(TEMPLATES) if (e := ends(parse_template(m), words, s))}
            assert made.longest(iter(words[s:])) == want


def test_faulty_markup():
    for markup in ("a <<beginOptional>> b", "<<endOptional>> a", "a <<other>>"):
        with pytest.raises(ValueError):
            parse_template(markup)
    with pytest.raises(ValueError):
        Automaton(["<<beginOptional>>a<<endOptional>>"])


def test_covered():
    assert covered([(0, 0, 3), (1, 1, 1), (2, 2, 4), (3, 8, 1)]) == 7
