from __future__ import annotations

import random
import re

from cotag.llm import licenses
from cotag.llm.queries import QUERIES


def agree_by_hand(text: str, template: str) -> bool:
    def marks(t):
        t = " ".join(re.findall(r"[a-z0-9]+", t.lower()))
        cc = "by|nc|sa|nd|attribution|noncommercial|sharealike|noderivatives"
        found = re.findall(rf"(?=\b((?:version|v) [0-9]\w*|(?:lesser|affero|library) general|(?:{cc}) (?:(?:{cc})|[0-9]\w*))\b)", t)
        return set(found), {m for m in found if m.startswith("v")}

    (all_text, versions), (all_own, own_versions) = marks(text), marks(template)
    rest = all_own - own_versions
    return all_text <= all_own and (not own_versions or bool(own_versions & versions)) and (
        not rest or bool(rest & all_text))


def finds_by_hand(text: str) -> set:
    """Every unit against every template."""
    def pairs(t):
        w = re.findall(r"[a-z0-9]+", t.lower())
        return set(zip(w, w[1:], strict=False))

    spans, at, run = {(0, len(text))}, 0, None
    for line in [*text.split("\n"), ""]:
        if line:
            spans.add((at, at + len(line)))
            run = (run[0] if run else at, at + len(line))
        else:
            spans |= {run} if run else set()
            run = None
        at += len(line) + 1
    best: dict = {}
    for start, end in spans:
        unit = pairs(text[start:end])
        for name, template in licenses.TEMPLATES:
            b = pairs(template)
            both = len(unit) + len(b)
            n = len(unit & b)
            if unit and 2 * n >= licenses.LEAST_DICE * both - 1e-9 and (
                len(b) > licenses.NOTICE or agree_by_hand(text[start:end], template)
            ):
                key = name, start, end
                best[key] = max(best.get(key, 0), 2_000_000 * n // both)
    return {(*k, v) for k, v in best.items()}


MIT = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)
GPL = next(t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and len(t) > 200)
CASES = [
    "", "\n\n", "Released under the MIT License.", "before\nreleased UNDER the mit license\nafter\n\nend",
    MIT, MIT.replace(". ", ".\n").replace(", ", ",\n"), f"intro\n\n{GPL.replace('; ', ';' + chr(10))}\n\nend",
    MIT.replace("sublicense", "lend"), "the license", "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
    "İ\nReleased under the MIT License.", "Permission is hereby granted, free of charge",
]


def test_against_brute_force(make_docs):
    for text in CASES:
        assert set(licenses.Templates().scan(text)) == finds_by_hand(text), text
    docs = make_docs([*enumerate(CASES), (90, None), (91, CASES[2]), (91, CASES[2])])
    got = licenses.scan_licenses(docs).collect()
    for i, text in enumerate(CASES):
        assert {tuple(r)[1:] for r in got if r["doc_id"] == i} == finds_by_hand(text)
    assert sum(r["doc_id"] == 91 for r in got) == 2 * len(finds_by_hand(CASES[2]))
    assert not [r for r in got if r["doc_id"] == 90]


def test_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = {tuple(r) for r in QUERIES["op5_license_scan"](spark, sf_dir).collect()}
    assert got == {(d["doc_id"], *f) for d in docs for f in finds_by_hand(d["text"] or "")} and got


HEADERS = {licence: text for licence, text in licenses.TEMPLATES if "redistribute it and/or modify" in text and len(text) < 1000}


def test_each_standard_header_gives_its_own_identifier(make_docs):
    assert set(HEADERS) == {"GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0"}
    assert "as published by the Free Software Foundation; either version 2 of the License" in HEADERS["GPL-2.0"]
    cases = {}
    for licence, text in HEADERS.items():
        wrapped = "\n".join(" * " + text[i : i + 70] for i in range(0, len(text), 70))
        cases |= {text: licence, text.replace("This library", "Foo").replace("This program", "Foo"): licence,
                  f"/* {text} */\nint x;\n": licence, f"before it\n\n{wrapped.replace('-', '')}": licence}
        family = "Lesser " if licence[0] == "L" else "Affero " if licence[0] == "A" else ""
        version = licence.split("-")[1].removesuffix(".0")
        cases[f"Foo is licensed under the GNU {family}General Public License, version {version}."] = licence
        for end in ("", "-only", "-or-later"):
            cases[f"// SPDX-License-Identifier: {licence}{end}\nint main() {{}}"] = licence
    for licence in ("MIT", "Apache-2.0", "BSD-3-Clause", "MPL-2.0"):
        cases[f"# SPDX-License-Identifier: {licence}\nimport x"] = licence
    texts = list(cases)
    got = {}
    for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect():
        got.setdefault(r["doc_id"], set()).add(r["license"])
    for i, text in enumerate(texts):
        assert got.get(i) == {cases[text]}, text


def test_messy(messy):
    assert licenses.scan_licenses(messy).collect() == []
    assert licenses.scan_licenses(messy.limit(0)).count() == 0
    assert licenses.scan_licenses(messy, templates=()).count() == 0


APACHE = """Copyright 2020 Foo

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.

"""


def window_by_hand(words: list, template: str) -> int:
    """Best coefficient of all windows of words against one template."""
    def pairs(w):
        return set(zip(w, w[1:], strict=False))

    b = pairs(re.findall(r"[a-z0-9]+", template.lower()))
    best = 0
    for i in range(len(words)):
        for j in range(i + 2, len(words) + 1):
            a = pairs(words[i:j])
            best = max(best, 2_000_000 * len(a & b) // (len(a) + len(b)))
    return best


def test_notices_inside_longer_units(make_docs):
    lines = ["Foo is a small tool for bar. Released under the MIT License.",
             "This project is released under the MIT License.",
             "Copyright 2020 Foo. Released under the MIT License.", "Licensed under the MIT License.",
             "İ and so on, İİ, it is released under the MIT License, like much else"]
    code = "\n".join(f"x{i} = {i} + y{i}" for i in range(300))
    texts = [*lines, APACHE + code, (code + APACHE + code).replace("\n", " "), "under the tree the mit oven"]
    got = {}
    for r in licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect():
        got.setdefault(r["doc_id"], set()).add((r["license"], texts[r["doc_id"]][r["start"] : r["end"]], r["dice_ppm"]))
    for i in (0, 1, 2, 4):
        assert [(n, t.lower(), d) for n, t, d in got[i]] == [("MIT", "released under the mit license", 1_000_000)]
    assert got[3] == {("MIT", "under the MIT License", 2_000_000 * 3 // 7)}
    for i in (5, 6):
        ((_, text, dice),) = [f for f in got[i] if f[1].endswith("limitations under the License") and f[0] == "Apache-2.0"]
        assert text.startswith("Licensed under the Apache") and dice > 950_000
        assert {n for n, _, _ in got[i]} == {"Apache-2.0"}
    assert 7 not in got


def test_full_texts_inside_other_text(make_docs):
    words = " ".join(f"w{i}" for i in range(3000))
    texts = [f"{words}\n\nintro {t.replace(chr(10), ' ')} {words}" for _, t in licenses.TEXTS]
    found = licenses.scan_licenses(make_docs(list(enumerate(texts)))).collect()
    for i, (name, text) in enumerate(licenses.TEXTS):
        best = max((r["end"] - r["start"], r["license"], r["dice_ppm"]) for r in found if r["doc_id"] == i)
        assert best[1] == name and best[0] > 0.95 * len(text) and best[2] > 990_000, name
    bsd = next(i for i, (n, _) in enumerate(licenses.TEXTS) if n == "BSD-3-Clause")
    assert {r["license"] for r in found if r["doc_id"] == bsd} == {"BSD-3-Clause"}


def test_best_window_against_all_windows():
    small = tuple(t for t in licenses.TEMPLATES if len(t[1]) < 120)
    rng = random.Random(5)
    pool = sorted({w for _, t in small for w in re.findall(r"[a-z0-9]+", t.lower())})
    some = 0
    for _ in range(60):
        words = rng.choices(pool, k=12)
        for _ in range(2):
            part = re.findall(r"[a-z0-9]+", rng.choice(small)[1].lower())
            part[rng.randrange(len(part))] = rng.choice(pool)
            at = rng.randrange(len(words))
            words[at:at] = part
        for name, template in small:
            best = max((d for *_, d in licenses.Templates(((name, template),)).windows(words)), default=0)
            want = window_by_hand(words, template)
            some += want >= 850_000
            assert best == want if want >= 850_000 else best == 0
    assert some > 20
