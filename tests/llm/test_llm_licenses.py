import random

from cases import clashing, frame, rows

from ferrite.llm.licenses import CONTAINED, TEMPLATES, Scanner, _word_list, scanned


def shingles(words, n):
    return [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]


def test_planted_templates_are_found():
    rng = random.Random(2)
    scanner = Scanner(TEMPLATES)
    texts, want = [], []
    for name, t in TEMPLATES.items():
        for before in (0, 1, 3, 17, 200):
            left = " ".join(f"q{rng.randrange(99)}" for _ in range(before))
            texts.append(f"{left} {t.upper()} {left}".encode())
            want.append(name)
    for name, text, found in zip(want, texts, scanner.matches(texts)):
        assert [m[0] for m in found] == [name]
        assert text[found[0][1]:found[0][2]].decode().lower().split()[0] == TEMPLATES[name].lower().split()[0]


def test_containment_decides():
    scanner = Scanner(TEMPLATES)
    words = TEMPLATES["mit-permission"].split()
    for changed in (0, 1, 2, 4, 20):
        text = list(words)
        for k in range(changed):
            text[5 + 3 * k] = f"zz{k}"
        own = set(shingles(_word_list(TEMPLATES["mit-permission"].encode()), 5))
        share = len(own & set(shingles(_word_list(" ".join(text).encode()), 5))) / len(own)
        found = [m for m in scanner.matches([" ".join(text).encode()])[0] if m[0] == "mit-permission"]
        assert bool(found) == (share >= CONTAINED)
        assert not found or abs(found[0][3] - share) < 1e-9


def test_documents(spark):
    got = scanned(clashing(spark, "License_Matches")).collect()
    assert len(got) == len(rows()) and not any(r.license_matches for r in got)
    some = [(1, "\u00e9\u00e9 All rights reserved. All rights reserved!", None, None, 0), (2, None, None, None, 0)]
    found = {r.doc_id: r.license_matches for r in scanned(frame(spark, some)).collect()}
    assert [(m.license, m.start, m.end) for m in found[1]] == [("all-rights-reserved", 3, 22), ("all-rights-reserved", 24, 43)]
    assert found[2] == [] and scanned(frame(spark, [])).count() == 0
