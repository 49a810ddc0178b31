"""Unknown examples of the licence model are whole lines, as scans see them."""

from palimpsest.llm import license_scan


def test_examples_are_whole_lines(spark):
    long = " ".join(f"word{i}" for i in range(300))
    docs = spark.createDataFrame([(1, f"short line\n{long}\n")], "doc_id long, text string")
    assert sorted(license_scan.example_paragraphs(docs)) == sorted([b"short line", long.encode()])
