"""License notices that are wrapped over several lines are found."""

from wayweave.llm.license_scan import TEMPLATES, scan_licenses, tokens


def wrap(text, at):
    w = text.split(" ")
    return "\n * ".join(" ".join(w[i : i + at]) for i in range(0, len(w), at))


def test_wrapped_notices(spark):
    rows, want = [], []
    for label, texts in sorted(TEMPLATES.items()):
        for t in texts:
            for at in (2, 5):
                for before in (0, 37, 300):
                    if len(tokens(t)) > 3:
                        rows.append((len(rows), "filler\n" * before + wrap(t, at) + "\nmore words" * 90))
                        want.append(label)
    rows += [(len(rows), "granted free\nof charge"), (len(rows) + 1, "no\nnotice\nhere")]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, label in enumerate(want):
        assert label in got[i].labels.split(",") and got[i].score >= 0.8, (i, label)
    assert got[len(want)].labels == got[len(want) + 1].labels == ""
