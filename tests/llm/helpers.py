"""Small tables with every awkward case, and helpers of the operators' tests."""

AWKWARD = [
    (1, "alpha beta gamma delta " * 30, "en", "a"),
    (1, "alpha beta gamma delta " * 30, "en", "a"),
    (1, "another text under the same id", "en", None),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \n\t ", "de", "b"),
    (None, "no id here, mail a.b@c.example.org", "fr", "b"),
    (None, None, None, None),
    (5, "x" * 50_000, "en", "a"),
    (6, "One two. three\n" * 3000, "en", "b"),
    (7, "<|endoftext|> it's <|im_end|>\n <|im_start|> tag", "en", "a"),
    (8, "été 你好 \U0001f389 é   end", "fr", "a"),
]
#: Names that operators use inside.
CLASHING = ("_id", "_text", "_key", "words", "key", "size", "at", "n", "start", "group", "component_id",
            "n_words", "kept", "bin", "block", "file", "page_id", "_row")


def documents(spark, rows, clashing=False):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    if clashing:
        schema += "".join(f", `{c}` string" for c in CLASHING)
        data = [(*r, *(f"x{i}" for i in range(len(CLASHING)))) for r in data]
    return spark.createDataFrame(data, schema)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)
