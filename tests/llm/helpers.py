"""Small tables with every awkward row, and brute-force answers."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, node string, kept string, shard string"


def sentence(seed, n):
    chance = random.Random(seed)
    return " ".join(chance.choice("the of and ship tide über niño rope mast keel crew wind port star bay 漢字".split()) + str(chance.randrange(60)) for _ in range(n))


def awkward_rows():
    base = sentence(1, 120)
    near = base.replace(" ", " ", 1).rsplit(" ", 3)[0] + " one two three"
    texts = [
        None, "", "   \n\t ", "one", "one two three four", base, base, near, base.upper(), sentence(2, 60),
        "same line here\n" * 30, "word " * 200, sentence(3, 9000), "a" * 50_000, "x|y*z#$%&<>", " nbsp here",
        "\x00nul \x0b vt", "The of and\nthe of and", sentence(4, 19), sentence(5, 20),
    ]
    rows = [(i, text, [None, "en", "xx"][i % 3], [None, "s1", "s2", "s1"][i % 4], None, 7, "n", "k", "z") for i, text in enumerate(texts)]
    rows.append((None, sentence(6, 30), "en", "s1", 1, 7, "n", "k", "z"))
    rows.append((5, base, "xx", "s1", None, 7, "n", "k", "z"))  # a repeated row
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def counts(text):
    text = text or ""
    tokens = words(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}
    n = len(tokens)
    return {
        "n_words": n,
        "word_chars": sum(map(len, tokens)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 20 or 100 * len(covered) > 30 * n,
    }


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def runs(text, n=5):
    tokens = [low(word) for word in words(text)]
    return {tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1)} if len(tokens) >= n else ({tuple(tokens)} if tokens else set())


def classes(pairs, threshold=0.8):
    """Smallest id among near-duplicates, for (id, text) pairs; every pair is compared."""
    sets = [runs(text) for _, text in pairs]
    parent = list(range(len(pairs)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for at, (key, _) in enumerate(pairs):
        root = find(at)
        least[root] = key if least.get(root) is None else min(least[root], key if key is not None else least[root])
    return [least[find(at)] for at in range(len(pairs))]
