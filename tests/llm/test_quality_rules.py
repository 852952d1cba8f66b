import random
import re
from collections import Counter

from snapflow.llm.quality_rules import Rules, apply_rules, base_counts, quality_rules

SPACE = "\x20\x09-\x0d"


def brute_counts(text):
    text = text or ""
    found = re.findall(f"[^{SPACE}]+", text)
    windows = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    covered = set()
    for i in range(len(found) - 4):
        if windows[tuple(found[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    seen, dups = [], 0
    for line in text.split("\n"):
        dups += line in seen and bool(re.search(f"[^{SPACE}]", line))
        seen.append(line)
    n = len(found)
    return (
        n,
        sum(map(len, found)),
        sum(c in "#*$%&|<>" for c in text),
        dups,
        len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def test_base_counts():
    rng = random.Random(1)
    texts = [None, "", " ", "a b c d e", "a b c d e a b c d e", "x\n\nx\nx\u00a0y", "\u00e9\x0b#|"]
    texts += [
        "".join(rng.choice("ab \n\t#\u00e9") for _ in range(rng.randint(0, 80))) for _ in range(300)
    ]
    texts.append("a b c d e f " * 5000)
    for text in texts[:-1]:
        assert base_counts(text, Rules()) == brute_counts(text)
    assert base_counts(texts[-1], Rules())[4] == 30_000


def brute_kept(docs, rules):
    """(key, row) of kept rows with the words left, over (key, text, host) rows."""
    lines, texts = {}, {}

    def normal(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return " ".join(re.findall(f"[^{SPACE}]+", low))

    for _, text, host in docs:
        texts.setdefault(host, set()).add(text or "")
        for line in (text or "").split("\n"):
            if normal(line):
                lines.setdefault((host, normal(line)), set()).add(text or "")
    out = []
    for key, text, host in docs:
        left = n = brute_counts(text)[0]
        for line in (text or "").split("\n"):
            holders = len(lines.get((host, normal(line)), ()))
            if holders > rules.line_docs and 100 * holders > rules.line_percent * len(texts[host]):
                left -= len(normal(line).split(" "))
        failed = brute_counts(text)[5]
        kept = not failed and left >= rules.min_words and 100 * left >= rules.left_percent * n
        out.append((str(key), left, kept))
    return sorted(out)


def random_docs(seed):
    rng = random.Random(seed)
    common = ["All rights reserved here.", "Menu  home news sport", "one two three four five six seven"]
    docs = []
    for key in range(120):
        text = [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randint(1, 15))) for _ in range(3)]
        text += [c for c in common if rng.random() < 0.6]
        docs.append((key, "\n".join(text), rng.choice(["h1", "h1", "h2", None])))
    docs += [(200, None, "h1"), (201, "", None), (None, docs[0][1], docs[0][2]), docs[1], docs[1]]
    docs += [(300 + i, docs[2][1], docs[2][2]) for i in range(40)]
    return docs


def test_verdicts_equal_brute_force(spark):
    rules = Rules(line_docs=5, line_percent=20)
    docs = random_docs(2)
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, source string, host int")
    got = quality_rules(frame, rules=rules).collect()
    expected = brute_kept(docs, rules)
    assert sorted((str(r["doc_id"]), r["words_left"], r["kept"]) for r in got) == expected
    assert 0 < sum(k for *_, k in expected) < len(expected)
    kept = apply_rules(frame, rules=rules)
    assert kept.columns == frame.columns
    rows = kept.collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(k for k, _, keep in expected if keep)
    left = dict((k, n) for k, n, _ in expected)
    assert all(len(r["text"].split()) == left[str(r["doc_id"])] for r in rows)
    assert quality_rules(frame.limit(0)).collect() == [] == apply_rules(frame.limit(0)).collect()


def test_copies_count_once_and_stay(spark):
    text = "\n".join(" ".join(f"word{i}{j}" for j in range(8)) for i in range(4))
    frame = spark.createDataFrame([(i, text, "h") for i in range(60)], "doc_id long, text string, source string")
    assert quality_rules(frame).filter("kept").count() == 60


def test_rows_of_one_id_and_text_are_judged_by_their_own_host(spark):
    line = " ".join(f"often{i}" for i in range(12))
    own = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(30)]
    rows = [(100 + k, own[k] + "\n" + line, "crowd") for k in range(30)]
    rows += [(100, own[0] + "\n" + line, "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = apply_rules(frame).collect()
    assert len(kept) == len(rows)
    assert {r["text"] for r in kept if r["source"] == "other"} == {own[0] + "\n" + line}
    assert {r["text"] for r in kept if r["source"] == "crowd"} == set(own)


INTERNAL = "id host hash row gone text_hash kept_id host_of_row text_of_row kept often mark".split()


def test_columns_of_internal_names_come_through(spark):
    text = " ".join(f"word{i}" for i in range(30))
    frame = spark.createDataFrame(
        [(1, text, "s", *range(len(INTERNAL))), (2, "short", "s", *range(len(INTERNAL)))],
        "doc_id long, text string, source string, " + ", ".join(f"{c} int" for c in INTERNAL),
    )
    out = apply_rules(frame)
    assert out.columns == frame.columns
    assert [tuple(r) for r in out.collect()] == [(1, text, "s", *range(len(INTERNAL)))]
