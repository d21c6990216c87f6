"""Survey answers from codes to labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.columns import quoted
from ..session import known_size

# The agreement scale.
AGREEMENT = {
    "1": "Strongly Agree",
    "2": "Somewhat Agree",
    "3": "Neither agree nor disagree",
    "4": "Somewhat Disagree",
    "5": "Strongly Disagree",
}

DEFINITION_DDL = (
    "questions map<string, struct<questionName: string, questionType: struct<type: string>, "
    "choices: map<string, struct<choiceText: string>>>>"
)


def choice_labels(definitions: DataFrame, body: str) -> DataFrame:
    """Question, code and label of every multiple-choice answer in a definition."""
    parsed = definitions.select(F.explode(F.from_json(body, DEFINITION_DDL)["questions"]).alias("_id", "q"))
    choices = parsed.filter(F.col("q.questionType.type") == "MC").select(
        F.col("q.questionName").alias("question"), F.explode("q.choices").alias("code", "choice")
    )
    return choices.select("question", "code", F.col("choice.choiceText").alias("label"))


def decode_answers(
    answers: DataFrame,
    labels: DataFrame,
    choice_columns: Sequence[str],
    agreement_columns: Sequence[str],
    other_text: Mapping[tuple[str, str], str],
    unknown: str = "Old",
) -> DataFrame:
    """Codes to labels, in place.

    The labels of a question are joined to its column by code, so a survey may have
    any number of choices; of two labels for one code the first by text counts.
    ``other_text`` names the text column that answers a question's "other"
    code.  A blank stays blank; an unknown code becomes ``unknown``.
    """
    known = known_size(labels.groupBy("question", "code").agg(F.min("label").alias("label")))
    decoded = {}
    for i, column in enumerate(choice_columns):
        c, label = F.col(quoted(column)), f"_label_{i}"
        own = known.filter(F.col("question") == column.split(" ")[0]).select(F.col("code").alias(f"_code_{i}"), F.col("label").alias(label))
        answers = answers.join(own, c == F.col(f"_code_{i}"), "left").drop(f"_code_{i}")
        text_of = F.coalesce(F.col(label), F.lit(unknown))
        for (question, code), text in other_text.items():
            if question == column:
                text_of = F.when(c == code, F.col(quoted(text))).otherwise(text_of)
        decoded[column] = F.when(c.isNotNull(), text_of)
    scale = F.create_map(*[F.lit(x) for pair in AGREEMENT.items() for x in pair])
    for column in agreement_columns:
        decoded[column] = F.try_element_at(scale, F.col(quoted(column)))
    labelled = [f"_label_{i}" for i in range(len(choice_columns))]
    return answers.withColumns(decoded).drop(*other_text.values(), *labelled)
