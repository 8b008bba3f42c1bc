"""Documents with everything that an operator must bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp long, row string, component_id string"

WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed"]) for _ in range(n))


def texts():
    long = "\n".join(prose(200, k) for k in range(400))  # about half a megabyte
    return [
        None,
        "",
        " \t\n",
        "...,,, 123 %%%",
        "a",
        prose(60, 1),
        prose(60, 1),
        prose(60, 1) + " more",
        prose(300, 2),
        "x" * 300_000,
        long,
        "été déjà vu où l'école 中文字 Σίσυφος İstanbul ½ ⅷ ́ é  nbsp  em \x1c sep",
        "<|endoftext|>hello<|startoftext|> world's don't WE'LL 2024!!! ...",
        "same line of words here\n" * 30,
        prose(12, 3),
    ]


def rows():
    out = []
    for k, text in enumerate(texts()):
        out.append((k, text, [None, "en", "fr"][k % 3], "s", None if text is None else len(text), None, 7, "r", "c"))
    out.append(out[5])  # a repeated row
    out.append((None, "nothing is known of this document and its many words, at all", None, None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None, None))
    return out


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)
