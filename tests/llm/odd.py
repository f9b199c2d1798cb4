"""A small table with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, n_lines string, "
    "size string, target string, taken string, hash string, component_id string, kept string, `count` string, `a.b` string"
)


def rows() -> list[tuple]:
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(120)
    passage = prose(60)
    words = base.split(" ")
    near = [" ".join(w if rng.random() > 0.004 else word() for w in words) for _ in range(6)]
    line = "  The Same LINE here \t"
    texts = [
        None, "", " \t\n\x0b\f\r ", "\n\n", "one", "two words", "Ünï Çødé İ ß 漢字 𝒳 word", base, base, base.upper(), *near,
        prose(30) + " " + passage + " " + prose(20), passage + "\n" + prose(10), prose(5) + " " + passage, passage,
        prose(40) + "\n" + line + "\n" + prose(5), *[f"{prose(25)}\n{line}\n\n{prose(3)}" for _ in range(12)],
        " ".join(["is onhe."] * 200), prose(3000), "x" * 5000, "\n".join([prose(9)] * 30) + "\n" + prose(30), "<|endoftext|> a <|x 's don't 1234 !!",
        "a\x1cb\x85c\u00a0d\u2003e", "e\u0301 \u212b \ufb01 \u03a3\u03a3",
    ]
    out = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t) if t is not None else None) for i, t in enumerate(texts)]
    out += [out[7], out[7], out[0], (None, base, None, None, None), (None, None, None, None, None), (None, prose(70), "en", "s0", 1), (3, passage, "x", "s1", None)]
    extra = ("k", None, "n", "s", "t", "w", "h", "c", "y", "z", "d")
    return [(*r, *extra) for r in out]
