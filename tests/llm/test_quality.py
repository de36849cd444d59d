import random
import re
import unicodedata
from collections import Counter

import pyarrow as pa

from helixframe.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_measures_equal_plain_ones():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "a b c d e f\n" * 3]
    texts += ["".join(rng.choice(["a", "b", "é", "%", " ", " ", "\n", "\t", "\x0b", "\x1c", " "]) for _ in range(rng.randint(0, 120))) for _ in range(300)]
    assert [r[:5] for r in quality.measured(pa.array(texts))] == [plain(t) for t in texts]


OPEN = set("#*%&@/\\,-›»•")


def plain_verdict(text, common):
    """Kept or not, and the characters lost, by the rules as they are described."""
    text = text or ""
    words = len(WORD.findall(text))
    n_words, chars, _, _, covered = plain(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]

    def by_itself(x):
        n, symbols = len(WORD.findall(x)), len(re.findall(r"[#*$%&|<>]", x))
        if x.strip(" \t\x0b\x0c\r") in common:
            return "boilerplate"
        if symbols > 0.3 * n + 1:
            return "navigation" if len(re.findall("[|›»•]", x)) > 0.2 * n else "symbols"
        if len(re.findall("[›»•]", x)) > max(2, 0.2 * n):
            return "navigation"
        if x.count("!!") + x.count("??") > 0.2 * n + 1:
            return "punctuation"
        last = x.rstrip(" \t\x0b\x0c\r")[-1]
        if n <= 6:
            return None if last not in OPEN and unicodedata.category(last) in ("Po", "Pe", "Pf") else "open"
        return "capitals" if x.isupper() else None

    verdicts = [by_itself(x) for x in lines]
    lost = sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x, v in zip(lines, verdicts) if v)
    return not (words < 10 or 100 * covered > 20 * n_words) and lost <= 0.5 * chars, lost


def test_rules_and_verdicts(spark):
    clean = "\n".join(["The small house by the lake was sold twice that year.", "Nobody knew who had bought it, or why."] + ["Rain fell on the harbour for nine days without a pause.", "Later a letter came from the north, unsigned and short."])
    rows = {
        1: clean, 2: "of | a | the | in | menu | that | was | on | to | be | it | as", 3: "THE!! SHIP!! WAS!! LOST!! AT!! SEA!! AND!! NEVER!! FOUND!! AGAIN!!", 4: "the### ship*** was&&& lost%%% at*** sea### and*** never&&& found%%% again***",
        5: clean + "\nHome Menu Login\nSearch\n" + clean.upper(), 6: "one two three four five. " * 8, 7: None, 8: "too short", 9: "Home\nMenu\nLogin\nSearch\nContact\nAbout\nHelp\nShare\nPrint\nNext", 10: "\xa0\n" + clean + "\n\x85", 11: clean + "\nby the lake",
    }
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows.items()], "doc_id long, text string, kept string, quality string")
    out = quality.judge_quality(docs)
    got = {r["doc_id"]: r["quality"] for r in out.collect()}
    assert {i for i, q in got.items() if q["kept"]} == {1, 10, 11}
    assert got[1]["cleaned"] == clean == got[11]["cleaned"] and got[5]["failed_lines"] == {"navigation": 2, "capitals": 4} and got[11]["failed_lines"] == {"punctuation": 1}
    assert {i for i, q in got.items() if q["base_failed"]} == {6, 7, 8}
    assert quality.judge_quality(docs.limit(0)).count() == 0


def test_boilerplate_is_what_stands_in_many_places_and_verdicts_equal_plain_ones(spark):
    rng = random.Random(8)
    sentence = lambda: " ".join(rng.choice(["rain", "fell", "the", "on", "É", "harbour", "%", "night", "a"]) for _ in range(rng.randint(2, 14))) + rng.choice([".", "", "!", ",", "!!", " |", "\xa0"])
    notice, copied = " All of this is under the licence of the house.", "This stands in one text that was copied often, again and again."
    rows = []
    for i in range(120):
        lines = [sentence() for _ in range(rng.randint(1, 9))]
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), notice + rng.choice(["", " ", "\t"]))
        rows.append((i if i % 10 else None, "\n".join(lines)))
    rows += [(500 + i, "Before it comes this line here.\n" + copied + "\nAfter it comes that one.") for i in range(200)] + [(900, sentence() * 20_000), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    places = {}
    for _, text in rows:
        lines = [x.strip(" \t\x0b\x0c\r") for x in text.split("\n") if WORD.search(x)]
        for before, x, after in zip(["", *lines], lines, [*lines[1:], ""]):
            places.setdefault(x, set()).add((before, after))
    common = {x for x, p in places.items() if len(p) >= 12}
    assert notice.strip() in common and copied not in common
    got = sorted((str(r["doc_id"]), r["text"], r["quality"]["kept"], r["quality"]["lost_chars"]) for r in quality.judge_quality(docs).collect())
    assert got == sorted((str(i), t, *plain_verdict(t, common)) for i, t in rows)
