"""Small hard texts and brute-force helpers shared by the tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

AWKWARD = [
    None, "", " ", "\n\n\t\x0b\x0c\r ", "one", "One two THREE", "a b c d", "a b c d e", "A B C D E", "a b c d e f", "é É ß x y",
    "x" * 70_000 + " y", "tab\tsep\x0bvt\x0cff\rcr", "😀 😀 😀 😀 😀 😀", "\x00 \x1c \x85 null", "a\n\na\n a\na", "w " * 3000,
]


def random_texts(seed, n, vocabulary=40, longest=80):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choice("abcdeéü") for _ in range(rnd.randint(1, 6))) for _ in range(vocabulary)]
    return [rnd.choice(["", " "]) + "".join(rnd.choice(pool) + rnd.choice([" ", " ", "  ", "\n", "\t"]) for _ in range(rnd.randint(0, longest)))
            for _ in range(n)]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
