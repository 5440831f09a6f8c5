"""Line dedup deals the keys once and looks the texts of its classes up once, however many rounds compare them."""

from locusloom.llm import line_dedup
from locusloom.llm.scratch import Scratch


def test_keys_and_texts_once(spark, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    rows = [(d, "\n".join(" ".join(words[(d * 7 + j + k) % 40] + ("x" if k == d % 20 else "") for k in range(20)) for j in range(3))) for d in range(30)]
    cuts, cut = [], Scratch.cut

    def watched(self, df, name):
        if any(word in name for word in ("texts", "met", "rows", "nodes")):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            cuts.append((name, plan.count("norm") > 0, "Generate" in plan))
        return cut(self, df, name)

    monkeypatch.setattr(Scratch, "cut", watched)
    removed = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).where("removed_lines > 0").count()
    assert removed > 0
    assert [name for name, text, _ in cuts if text and "text" in name] == ["texts"]
    assert [name for name, _, dealt in cuts if dealt and name in ("met", "rows")] == ["met"]
