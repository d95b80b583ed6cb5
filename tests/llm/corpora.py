"""Small corpora for tests: hand-made rows for the edge cases, and random texts with copies, near copies and shared passages."""

from __future__ import annotations

import random

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, key string, size double, h string, names string, repeats int, score double"


def rows(texts, langs=None, sources=None) -> list[tuple]:
    made = []
    for i, t in enumerate(texts):
        lang = langs[i] if langs else ("en", "fr")[i % 2]
        source = sources[i] if sources else f"s{i % 3}"
        made.append((i, t, lang, source, len(t or "")))
    return made


def edge_rows() -> list[tuple]:
    long = " ".join(f"w{i % 997}q{i % 31}" for i in range(60_000))
    same = "one two three four five six seven eight nine ten " * 3
    made = [
        (0, None, None, None, None),
        (1, "", "en", None, 0),
        (2, " \n\t\x0b\x0c\r", "en", "a", 6),
        (3, same, "en", "a", 1),
        (4, same.replace(" ", "\n"), "en", "a", 1),
        (5, same + " ", "fr", "b", 1),
        (5, same + " ", "fr", "b", 1),  # a repeated row
        (5, "another text with the same id", "fr", "b", 1),
        (None, same, None, "b", 1),
        (None, "no id here", "en", None, 1),
        (6, long, "en", "b", 1),
        (7, long + " tail", "en", "c", 1),
        (8, "🙂 héllo wörld\xa0x 中文字 " * 30, "de", "c", 1),
        (9, "a", "de", "Ä", 1),
        (10, "###$$$ %%% &&&" * 20, None, "b", 1),
        (-3, same, "en", "a", 1),
    ]
    return made


def random_texts(n: int, seed: int, vocabulary: int = 60) -> list[str]:
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(vocabulary)]
    passages = [" ".join(r.choices(words, k=r.randint(20, 90))) for _ in range(4)]
    out: list[str] = []
    for _ in range(n):
        kind = r.random()
        if out and kind < 0.2:
            out.append(r.choice(out))
        elif out and kind < 0.4:
            w = r.choice(out).split()
            if w:
                w[r.randrange(len(w))] = r.choice(words)
            out.append("\n".join(w))
        else:
            parts = [" ".join(r.choices(words, k=r.randint(0, 120)))]
            if r.random() < 0.5:
                parts.insert(r.randint(0, 1), r.choice(passages))
            if r.random() < 0.2:
                parts.append(f"{r.choice(words)} " * r.randint(2, 40))
            out.append(r.choice((" ", "\n", "  ")).join(parts))
    return out


def table(spark, found, partitions: int = 3):
    return spark.createDataFrame(found, DDL).repartition(partitions)


def clashing(spark, found):
    more = (True, "r", "k", 1.5, "h", "n", 7, 0.25)
    return spark.createDataFrame([r + more for r in found], CLASHING)


def listed(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
