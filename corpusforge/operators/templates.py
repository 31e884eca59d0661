"""Text of instruction, exam, code and translation records. A null in a field that a form needs gives a null text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import LEXICON, contains_any, has_fence, let, strip, tokens

# Labels of the forms.
ANSWER = "Jawapan: "
TASK = "Jawab soalan berikut."
TRANSCRIPT = "below is the text from pseudolabel youtube videos in Malay and English,\n\nMalay:\n"
TRANSCRIPT_OTHER = "\n\nEnglish:\n"
# End of fixed values.

QUESTIONS = "array<struct<question:string,A:string,B:string,C:string,D:string,answer:string>>"


def glued(*parts: Column | str) -> Column:
    """Columns and literal strings in a row."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def by_lines(*parts: Column) -> Column:
    return glued(*[x for p in parts for x in (p, "\n")][:-1])


def nested(record: Column, *path: str) -> Column:
    """A field at a constant path of a JSON record."""
    return F.get_json_object(record, "$." + ".".join(path))


def choice_lines(choices: Column) -> Column:
    """``key. value`` lines of a map, in its order."""
    return F.array_join(F.transform(F.map_entries(choices), lambda e: F.concat(e["key"], F.lit(". "), e["value"])), "\n")


def choice_forms(context: Column, question: Column, choices: Column, answer: Column) -> Column:
    """The same exercise twice: answer bare, and answer labelled."""
    head = by_lines(context, question, choice_lines(choices))
    return F.array(glued(head, "\n", answer), glued(head, "\n" + ANSWER, answer))


def paragraph_questions(paragraph: Column, questions: Column) -> Column:
    """One text per question (``QUESTIONS``) about the paragraph, with its four choices."""

    def one(q: Column) -> Column:
        lines = [glued(f"{k}. ", q[k]) for k in "ABCD"]
        return glued(paragraph, "\n\n", by_lines(q["question"], *lines, glued(ANSWER, q["answer"])))

    return F.transform(questions, one)


def exam(question: Column, answer: Column) -> Column:
    return glued(question, "\n" + ANSWER, answer)


def exam_of_objective(objective: Column, context: Column, question: Column, answer: Column) -> Column:
    return glued(by_lines(objective, context, question), "\n\n" + ANSWER, answer)


def numbered_exam(question: Column, choices: Column, answer: Column) -> Column:
    """A question without its number, its lines of choices, and the label of the first choice that holds the answer.

    The label is ``None`` where no choice holds it. The number is what comes before the first ``") "``; a question
    without one is empty, as is one that consists of its number.
    """
    body = strip(F.when(F.instr(question, ") ") > 0, F.regexp_replace(question, r"(?s)^.*?\) ", "")).otherwise(F.lit("")))
    wanted = strip(answer)

    def text(lines: Column) -> Column:
        hit = F.get(F.filter(lines, lambda c: c.contains(wanted)), F.lit(0))
        label = F.coalesce(F.substring_index(hit, ".", 1), F.lit("None"))
        return glued(TASK + "\n", body, "\n\n", F.array_join(lines, "\n"), "\n" + ANSWER, label)

    return let(F.filter(F.split(choices, "\n"), lambda c: F.length(c) > 0), text)


def fenced(text: Column) -> Column:
    """The text if it holds a code fence, else null."""
    return F.when(has_fence(text), text)


def paired_lists(prompt: Column, response: Column) -> Column:
    """The second items of two lists of two; null for lists of other lengths."""
    return F.when((F.size(prompt) == 2) & (F.size(response) == 2), glued(F.get(prompt, F.lit(1)), " ", F.get(response, F.lit(1))))


def transcript(first: Column, second: Column) -> Column:
    return glued(TRANSCRIPT, first, TRANSCRIPT_OTHER, second)


def dialect(name: str, left: Column, right: Column) -> Column:
    """A sentence and its standard form, one direction; null where a side has no or too many words or foreign ones."""
    bounded = [(F.length(x) > 0) & (F.size(tokens(x)) < 2000) for x in (left, right)]
    return F.when(bounded[0] & bounded[1] & ~contains_any(right, LEXICON), glued(f"{name} to Standard Malay: ", left, " ", right))
