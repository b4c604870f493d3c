"""Small tables with every awkward case, and brute-force counterparts."""

import re


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = "score double, h string, fp bigint, words string, n bigint, round int, ids string, part int, key string, root bigint, _id string, _hash string, _text_md5 string"


def docs(spark, texts, extra=False):
    """Texts as documents; with ``extra``, columns whose names the operators use inside."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in (c.split()[0] for c in CLASHING.split(", ")):
            df = df.withColumn(name, df["lang"])
    return df


def awkward(spark, extra=True):
    """Nulls in every column, empty and very long texts, repeated rows and ids."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    base = docs(spark, ["", None, "one", "two words", long, "a b c d e f g", "a b c d e f g"], extra)
    odd = base.filter("doc_id = 5").selectExpr("cast(null as bigint) as doc_id", *[f"cast(null as {t}) as `{c}`" if c != "text" else "text" for c, t in base.dtypes if c != "doc_id"])
    none = odd.withColumn("text", odd["text"].substr(1, 0)).selectExpr("doc_id", "cast(null as string) as text", *[f"`{c}`" for c in base.columns if c not in ("doc_id", "text")])
    return base.unionByName(odd).unionByName(none).unionByName(base.filter("doc_id = 6"))


def empty(df):
    return df.limit(0)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])


