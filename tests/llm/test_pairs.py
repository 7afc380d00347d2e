import pytest
from pyspark.sql import functions as F

from plotmill.llm.pairs import defects, flag_pairs

ASK = "Write a scene where\n- the warden lifts the copper letter\n- Oryne feels pride at dawn"
TALE = 'The harbour was quiet. "Leave it," said Oryne, and the warden went with the others to the gate.'
GERMAN = "Die Köchin trug das Seil mit großer Sorge, aber die Witwe fand den Brief unter der Brücke."


@pytest.mark.parametrize(
    ("ask", "told", "found"),
    [
        (ASK, TALE, []),
        (ASK, None, ["empty"]),
        (None, "", ["empty"]),
        (ASK, " ​\n", ["empty"]),
        (ASK, "N/A", ["empty"]),
        (ASK, "(no story)", ["empty"]),
        (ASK, "—", ["empty"]),
        (ASK, TALE + " The tired capt", ["truncated"]),
        (ASK, TALE + " In the small hours,", ["truncated"]),
        (ASK, TALE + ' "', ["truncated"]),
        (ASK, TALE + ' "Come here.', ["truncated"]),
        (ASK, "I'm sorry, but I can't write this scene. Perhaps a gentler tone would work?", ["refusal"]),
        (ASK, "Es tut mir leid, ich kann diese Geschichte nicht schreiben.", ["refusal"]),
        (ASK, 'Oryne refused to go on. "I won\'t do it," said the warden.', []),
        (ASK, '"I\'m sorry, but I can\'t write that letter," said Oryne. ' + TALE, []),
        (ASK, "Here you are: the warden lifts the copper letter. Oryne feels pride at dawn.", ["echo"]),
        (ASK, ASK.upper(), ["echo", "truncated"]),
        (ASK, ASK + "\nThen the harbour fell quiet.", ["echo"]),
        (ASK, ASK + "\n" + TALE * 6, []),
        (ASK, GERMAN * 3, ["language"]),
        ("Schreibe eine Szene, in der die Köchin mit dem Brief und der Witwe ist", GERMAN * 3, []),
        (ASK, "Она открыла дверь и увидела старый маяк за рекой.", ["language"]),
        (None, GERMAN, []),
        (ASK, TALE + " And still the cold light fell…", []),
        (ASK, TALE + "\n(Nobody ever came.)", []),
    ],
)
def test_defects(ask, told, found):
    assert defects(ask, told) == found


SORRY = "I'm sorry, but I can't write this scene."
LIST = "\n".join(f"{{}} a scene in which the warden and Oryne talk about the letter in the quiet harbour, number {k}" for k in range(12))
LONG_ASK = "Write one quiet scene in the manner of an old harbour tale where\n- the warden lifts the copper letter"


@pytest.mark.parametrize(
    ("ask", "told", "first"),
    [
        (ASK, f"{SORRY} Some alternatives:\n{LIST.format(*['-'] * 12)}.\nLet me know which one you like.", "refusal"),
        (ASK, f"{SORRY}\n\nYou might consider one of these:\n" + "\n".join(f"{k}. A gentler scene. Oryne is calm." for k in range(1, 8)), "refusal"),
        (ASK, " ".join([SORRY, "I cannot help with the letter.", "Please ask for another scene.", "Perhaps the harbour could be quiet."] * 12), "refusal"),
        (ASK, f"{SORRY} {TALE} " + "The warden kept the letter. " * 30, None),
        (ASK, "I could not help him. " + "The tide came in. The warden left. " * 20, None),
        (ASK, "The list was long.\n- bread\n- salt\nI could not help him.", None),
        (LONG_ASK, "The warden lifts the copper letter.", "echo"),
        (ASK, ASK + ".\nThen " + "and the harbour fell quiet " * 12 + "again.", "echo"),
        (ASK, ASK + ".\n" + "Then the harbour fell quiet. " * 12, None),
        ("Go on.", "Go on.", "echo"),
        ("Go on.", "Go on, said the warden.", None),
    ],
)
def test_no_cap_of_length(ask, told, first):
    assert next(iter(defects(ask, told)), None) == first


def test_table(spark):
    rows = [(1, ASK, None), (1, ASK, None), (2, None, TALE), (None, ASK, "N/A"), (3, "", TALE * 3000)]
    df = spark.createDataFrame(rows, "record_id bigint, ask string, told string").withColumn("key", F.lit(1))
    got = sorted(((r["record_id"], r["defect"], r["rank"]) for r in flag_pairs(df, "ask", "told").collect()), key=str)
    assert got == [(1, "empty", 1), (1, "empty", 1), (None, "empty", 1)]
    assert flag_pairs(df.limit(0), "ask", "told").count() == 0
