import pytest

from hiremill.functions.labels import DEFAULT_QUESTION
from hiremill.operators.routing import prompt_models, route_messages

CASES = [
    ("", "", "guidance"), (" \t", "\xa0", "guidance"), (None, None, "guidance"), ("hi", " ", "chat"), ("analyze", "", "chat"),
    ("", "cv", "skill_gap"), ("please START Analysis", "cv", "skill_gap"), ("my Skill Gap?", "cv", "skill_gap"),
    (" Analyze ", "cv", "skill_gap"), ("analyze this", "cv", "resume_qa"), ("who am I", "cv", "resume_qa"),
]


def test_routes(spark):
    df = spark.createDataFrame([(str(i), *c) for i, c in enumerate(CASES)], "id string, message string, pdf_text string, want string")
    for r in route_messages(df).collect():
        assert r.route == r.want
        assert (r.prompt is not None) == (r.want in ("chat", "resume_qa"))
        assert (r.reply is not None) == (r.want == "guidance")


@pytest.mark.parametrize("extra", [0, 1, 500])
def test_question_prompt_cuts_the_resume(spark, extra):
    cv = "é" * (3000 + extra)
    row = route_messages(spark.createDataFrame([(" q? ", f" {cv} ")], "message string, pdf_text string")).first()
    assert row.prompt == (
        f"Resume text:\n{cv[:3000]}\n\nUser question: q?\n\nAnswer using only the resume above."
    )
    assert DEFAULT_QUESTION not in row.prompt


def test_service_follows_the_model_name(spark):
    rows = [("gemini-2.5-flash", "hi"), ("llama3.1", "hi"), ("mistral", ""), ("gemini-x", "boom")]

    def cloud(model, prompt):
        if prompt == "boom":
            raise RuntimeError("down")
        return f" cloud {model} {prompt} "

    services = {"gemini": cloud, "ollama": lambda model, prompt: prompt}
    df = prompt_models(spark.createDataFrame(rows, "model string, prompt string"), services)
    assert [(r.provider, r.reply) for r in df.collect()] == [
        ("gemini", "cloud gemini-2.5-flash hi"), ("ollama", "hi"),
        ("ollama", "[Ollama Error] Empty response from model."), ("gemini", "[Gemini Error] down"),
    ]
