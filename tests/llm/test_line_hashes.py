"""Op 8 makes each line's hash once in a scan."""

import pandas as pd

from catchment.llm import line_dedup


def test_hashes_are_made_once_in_a_scan(documents, capsys):
    line_dedup.line_report(documents([(1, "a line of more than twenty letters")])).explain()
    plan = capsys.readouterr().out
    # One scan counts the documents of a line, the other finds its places.
    assert plan.count("md5(") == 2 and "size(transform(" not in plan and plan.count("trim(") == 2


def test_stripped_lines_of_all_kinds(documents, against_sql):
    lines = ["  A line that Three documents hold\t", "a line that three documents hold", "\x0b\x0cÀ LINE of letters É that stay as they are ", " À line of letters É that stay as they are",
             " twenty code pointsÉÉ", "short", "  \t ", "x" * 19 + " ", "X" * 20]
    texts = ["\n".join(lines[at:] + lines[:at]) for at in range(4)]
    rows = [*enumerate(texts), (9, "\n" + lines[0] + "\n"), (11, None), (12, "")]
    table = pd.DataFrame([{"doc_id": key, "text": text} for key, text in rows])
    against_sql(line_dedup.line_report(documents(rows)), line_dedup.ORACLE, documents=table)
