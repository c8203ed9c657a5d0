"""Small tables with the awkward rows every operator must take."""

import random

DOC_SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
              "h string, bucket string, label string, row string, n string")
WORDS = [a + b + c for a in ("ba", "ke", "lo", "mi", "tu") for b in ("ra", "sen", "ti", "vo")
         for c in ("", "n", "s")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def texts():
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 4, 20, 60, 120, 300)]
    out = base + [None, "", "   ", "\t\n", "One", "one", "ONE two", "é ü 漢字 🙂 " + prose(rng, 30)]
    for text in base[3:]:
        words = text.split()
        words[5] = "changed"
        out.append(" ".join(words))
        out.append(text.upper())
        out.append(text)
    passage = prose(rng, 70)
    out += [prose(rng, 40) + " " + passage + " " + prose(rng, 30), passage + " " + prose(rng, 90)]
    out.append(prose(rng, 4000))
    return out


def doc_rows():
    """Documents with nulls, copies, near copies, a long text, a repeated row, null ids and columns
    whose names the operators use themselves."""
    extra = ("x", "y", "z", "r", "q")
    rows = [(10 + i, t, "en" if i % 3 else None, f"s{i % 2}", len(t or ""), *extra)
            for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, rows[4][1], "de", None, None, *extra),
             (None, "only with a null id", None, None, None, *extra)]
    return rows


def docs(spark):
    return spark.createDataFrame(doc_rows(), DOC_SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
