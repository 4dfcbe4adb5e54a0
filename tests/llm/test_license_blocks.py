"""License notices that run over line ends, against every window of words."""

import re

import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import license_join  # noqa: E402

TEXTS = [
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted",
    "x y\n// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0",
    "Released under the MIT License.",
    "mehr\nreleased under\nthe MIT\nLicense.",
    "Released under the Apache License.",
    "permission is hereby granted " + "x " * 40 + "\nfree of charge to any person obtaining a copy of this software",
    "all\nrights\nreserved\n" * 50,
    "a\n" * 3000 + "Licensed under the\nApache License,\nVersion 2.0",
    None,
    "",
]


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    every, found = words(text), {}
    for label, t in license_join.TEMPLATES.items():
        listed = words(t)
        blocks = [words(x) for x in text.split("\n")] + [every[i : i + len(listed)] for i in range(len(every))]
        best = max(len(set(listed) & set(b)) for b in blocks) if blocks else 0
        if 10 * best >= 8 * len(set(listed)):
            found[label] = best / len(set(listed))
    return found


def test_blocks_across_line_ends(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_join.scan_licenses(docs, phrases={"no such phrase": "none"}).collect()}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert (got[i]["labels"], round(got[i]["score"], 9)) == (",".join(sorted(want)), round(max(want.values(), default=0), 9)), text
    assert [got[i]["labels"] for i in range(6)] == ["bsd", "mpl-2.0", "mit-short", "mit-short", "", ""]
