"""Windows by real sizes: bytes or a tokenizer's counts, filled to the budget."""

from pyspark.sql import functions as F

from hazeline.llm.chat import read_back, turn_bytes, windows

SCHEMA = "conv_id long, turn long, role string, text string, n long"


def sized(spark, rows, budget, history, size=None):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df if size else df.withColumn("size", turn_bytes(F.col("role"), F.col("text")))
    return sorted(windows(df, budget, history, size or "size").collect(), key=lambda r: r.window)


def test_sizes_are_those_of_the_formatted_text(spark):
    rows = [(1, t, "us<|er" if t % 2 else "assistant", f"é日 <|im_end|> \\ {t}" * (t % 5), None) for t in range(60)]
    parts = sized(spark, rows, 700, 100)
    assert len(parts) > 3
    for r in parts:
        assert r.n_tokens == len(r.formatted.encode()) and r.over_budget == (r.n_tokens > 700)
    assert not any(r.over_budget for r in parts)


def test_texts_without_spaces_are_split_by_size(spark):
    rows = [(1, t, "assistant", "漢" * 5000, None) for t in range(6)]
    parts = sized(spark, rows, 2048, 256)
    assert len(parts) == 6 and all(r.over_budget and r.n_tokens > 15_000 for r in parts)


def test_short_turns_fill_the_windows(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", " ".join(["words"] * 10), None) for t in range(2000)]
    for budget, history in ((2048, 256), (1024, 0), (4096, 1024)):
        parts = sized(spark, rows, budget, history)
        assert not any(r.over_budget for r in parts)
        fill = [r.n_tokens / budget for r in parts[1:-1]]
        assert sum(fill) / len(fill) > 0.85, (budget, sum(fill) / len(fill))


def test_a_tokenizers_counts_as_sizes(spark):
    rows = [(1, 0, "system", "s", 10), *((1, t, "assistant", f"text {t}", 7) for t in range(1, 40)), (1, 90, "user", "u", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = sorted(windows(df, 100, 20, "n").collect(), key=lambda r: r.window)
    assert all(r.n_tokens <= 100 for r in parts) and len(parts) == 5
    assert read_back(windows(df, 100, 20, "n")).first().n_turns == 41
