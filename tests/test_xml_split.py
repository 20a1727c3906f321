"""The splittable XML reader against the native one, row by row."""

import os

import pytest
from conftest import rows

from titlematch.sources import read_xml_lexed, read_xml_records, read_xml_rows
from titlematch.sources.xml import infer_xml_schema

SCHEMA = "title string, url string, abstract string, _id string"

HARD = [
    "<doc><title>plain</title><url>u1</url></doc>",
    '<doc id="7" lang=\'x>y\'><title>attributes</title></doc>',
    "<doc/>",
    "<doc><title>after a self-closing one</title></doc>",
    '<doc id="8"/>',
    "<doc><title>white space</title></doc >",
    "<doc ><title>after white space</title></doc\n>",
    "<!-- a <doc> comment --><doc><title>after a comment</title></doc>",
    "<!-- one --> <doc><title>between comments</title></doc> <!-- two -->",
    "<doc><title><![CDATA[a </doc> inside]]></title><url>u2</url></doc>",
    "<doc><title>x --> y</title><abstract><!-- </doc> -->z</abstract></doc>",
    "😀 𝄞 <doc><title>emoji 😀 before</title><url>u3</url></doc> 😀",
    "<docs>other</docs><doc><title>after a longer name</title></doc>",
    "<doc>\n <title>two\n lines</title>\n <abstract>a &amp; b</abstract></doc>",
]


def write(folder, text, name="hard.xml"):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("head", ["<feed>", '<?xml version="1.0"?>\n<feed kind="😀">', "\n <feed>\n"])
def test_hard_records_equal_native(spark, workdir, head):
    path = write(workdir, head + "\n".join(HARD) + "\n</feed>\n")
    own = rows(read_xml_records(spark, path, "doc", SCHEMA))
    if not head.startswith("\n"):
        assert own == rows(read_xml_rows(spark, path, "doc", SCHEMA))
    assert len(own) == len(HARD)


def test_many_splits_equal_native(spark, workdir):
    path = write(workdir, "<feed>" + "\n".join(HARD * 400) + "</feed>", "many.xml")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        own = read_xml_records(spark, path, "doc", SCHEMA)
        assert own.rdd.getNumPartitions() > 8
        got = rows(own)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == rows(read_xml_rows(spark, path, "doc", SCHEMA))


@pytest.mark.parametrize(
    "record",
    [
        "<doc><title>never closed</title>",
        "<doc><title>a</title><!-- the <doc> tag --></doc>",
        "<doc><title><![CDATA[<doc>]]></title></doc>",
        "<doc><title>a</title><docs>b</docs></doc>",
        "<doc><title>a</url></doc>",
        "<!-- <doc/> -->",
        "<!-- <doc><title>a</title></doc> -->",
    ],
)
def test_uncuttable_records_fail(spark, workdir, record):
    path = write(workdir, "<feed>" + record + "<doc><title>next</title></doc></feed>")
    with pytest.raises(Exception, match="closing tag|commented|MALFORMED|Malformed"):
        read_xml_records(spark, path, "doc", SCHEMA).collect()


def test_inference_reads_the_same_records(spark, workdir):
    path = write(workdir, "<feed>" + "\n".join(HARD) + "</feed>")
    assert {"title", "url"} <= set(infer_xml_schema(spark, path, "doc", 3).names)


NESTED = [
    "<doc><title>a</title><!-- the <doc> tag --></doc>",
    "<doc><title><![CDATA[<doc>]]></title></doc>",
    "<doc><title><![CDATA[</doc><doc/>]]></title><url><![CDATA[<!-- ]]></url></doc>",
    "<doc><title>a</title><docs>b</docs></doc>",
    "<!-- <doc/> -->",
    "<!-- <doc><title>a</title></doc> -->",
    "<!-- <![CDATA[ --><doc><title>after an odd comment</title></doc><!-- ]]> -->",
    "<?note <doc> ?><doc><title>after an instruction</title></doc>",
    "<doc><title>outer</title><links><doc><title>inner</title></doc><doc/></links><url>u</url></doc>",
    "<doc><title>long " + "x" * 3000 + "</title><abstract><![CDATA[" + "<doc> ]] > " * 400 + "]]></abstract></doc>",
    "<doc id='1'\n lang=\"a>b\"><title>attributes</title></doc>",
]


@pytest.mark.parametrize("size", ["100", "1k", "64k", "16m"])
def test_lexed_equals_native(spark, workdir, size):
    """Records that cannot be cut alone, in splits of any size."""
    for k in range(3):
        write(workdir, "<feed>" + "\n".join((NESTED + HARD[k:]) * (k * 3 + 1)) + "</feed>", f"part-{k}.xml")
    write(workdir, "<feed></feed>", "part-4.xml")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = rows(read_xml_rows(spark, workdir, "doc", SCHEMA))
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = rows(read_xml_lexed(spark, workdir, "doc", SCHEMA))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want and len(got) > 100


@pytest.mark.parametrize("text", ["<feed><doc><title>a</title>", "<feed><!-- <doc/>", "<feed><doc><![CDATA[x</doc></feed>", "<feed></doc></feed>"])
def test_lexed_unfinished_files_fail(spark, workdir, text):
    path = write(workdir, text)
    with pytest.raises(Exception, match="ends inside|without a row"):
        read_xml_lexed(spark, path, "doc", SCHEMA).collect()
