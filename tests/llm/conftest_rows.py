"""Documents with every awkward case: nulls, empty and long texts, copies, repeats, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, start int, salt int, content string, cls long, n long"


def words(rng, k, stems=("ka", "lo", "mi", "ne", "su", "ta", "re", "vo")):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(k))


def rows():
    rng = random.Random(11)
    out = []
    base = [words(rng, 60) for _ in range(12)]
    passage = words(rng, 55)
    for i, text in enumerate(base):
        out.append((i, text))
        out.append((100 + i, text.upper() if i % 3 == 0 else text))
        near = text.split(" ")
        near[10], near[40] = "changed", "words"
        out.append((200 + i, " ".join(near)))
        out.append((300 + i, f"{words(rng, 20)} {passage} {words(rng, 15)}"))
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "one two"), (404, "one two"), (405, "ONE two three four five six")]
    out += [(406, "x" * 5000), (407, "y z " * 3000), (408, "12 34 !!"), (409, "é日本 " * 80), (410, "a\x00b c")]
    out += [(411, words(rng, 30000)), (None, base[0]), (5, base[5]), (5, base[5])]
    return [(i, t, ("en", "fr", None)[k % 3], "s", len(t or ""), "k", 1, 2, "c", 3, 4) for k, (i, t) in enumerate(out)]
