"""Rows with every awkward case, for all operators."""

LONG = " ".join(f"word{i % 977} ünd, text-{i % 31}" for i in range(30_000))
TEXTS = [
    "It's a plain text, with 12 words; they'll do. And then\nsome more of them here.",
    "It's a plain text, with 12 words; they'll do. And then\nsome more of them here.",
    "",
    None,
    " ",
    "  two  blanks \n\n and\tlines  ",
    "<|endoftext|> x<|endoftext|>y </s> <s> <|ENDOFTEXT|> A<|endoftext|>. B<|EndOfText|>!",
    "Σ ΑΣ Σ. é ́x ﬁ   　 ▁a ▁ b",
    "日本語のテキスト、空白なし。" * 40,
    "x" * 5000,
    LONG,
    "🙂 a🙂b \x00 \x1c!\x1c",
]


def documents(spark, texts=TEXTS, more="kept string, n_tokens string, component_id string"):
    """Documents with null and repeated ids and columns named as results are."""
    rows = [(i, t, "a", "b", "c") for i, t in enumerate(texts)]
    rows += [(None, "a text without an id", "a", "b", "c"), (1, texts[1], "a", "b", "c")]
    return spark.createDataFrame(rows, f"doc_id long, text string, {more}")


def empty(spark):
    return documents(spark).limit(0)
