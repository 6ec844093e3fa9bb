import pytest
from pyspark.sql import functions as F

from tessella.llm import documented as D
from tessella.llm import handwritten as H

CODE = '''//! Inner text of the file is no documentation of a function here.
/// Adds two numbers and gives the sum back.
#[inline]
pub fn add(a: u8, b: u8) -> u8 { a + b }

/** Block text that says what happens. */
fn block() {}
/*** No documentation at all in this notation ***/
fn stars() {}
//// Neither is this line with four slashes here
fn slashes() {}
#[doc = "Given as an attribute, with a \\"quoted\\" word."]
fn attribute() {}
#[doc(hidden)]
#[doc(alias = "one two three four five")]
fn hidden() {}
/// Short words only.
fn short() {}
/// TODO: write down what this function does
fn todo() {}
/// Reads the bytes of the file.
fn read_file_bytes() {}
/// # A heading of many words stands here
/// ```
/// let fenced = code("with many words in it");
/// ```
fn only_code() {}
/// Declared without a body, so it is no case.
trait T { /// A method with a default body counts too.
    fn with_body(&self) { }
    /// A method without any body is no case.
    fn without(&self); }
macro_rules! m { () => { /// Text in a macro definition is no case.
    fn in_macro() {} } }
const TEXT: &str = "/// In a literal there is nothing to find.\\nfn literal() {}";
fn outer() {
    /// A nested function has documentation as well.
    fn nested() {}
}
/// The comment between does not part them.
// plain

fn parted() {}
'''


def test_documented_functions(spark):
    rows = [(1, "a.rs", CODE), (1, "a.rs", CODE), (2, "a.py", CODE), (3, "b.rs", None), (4, "c.rs", " "), (5, "d.rs", CODE.replace("\n", "\r\n")), (6, None, CODE), (7, "e.rs", "/// open and never closed it is\nfn x() {")]
    df = spark.createDataFrame(rows, "file_id long, file_path string, code string").withColumn("crate", F.lit("c")).withColumn("module", F.lit("m")).withColumn("start_line", F.lit(-1)).withColumn("name", F.lit("clash"))
    pairs = D.documented_pairs(df).collect()
    names = ["add", "block", "attribute", "with_body", "nested", "parted"]
    assert sorted((r.file_id, r.name) for r in pairs) == sorted((k, n) for k in (1, 5) for n in names)
    one = {r.name: r for r in pairs if r.file_id == 1}
    assert one["add"].doc_comments == "Adds two numbers and gives the sum back." and one["add"].full_text == "pub fn add(a: u8, b: u8) -> u8 { a + b }"
    assert one["attribute"].doc_comments == 'Given as an attribute, with a "quoted" word.'
    found = {(r.file_id, r.fn_line) for r in D.found(df).collect()}
    assert found == {(r.file_id, r.start_line) for r in pairs}
    assert CODE.split("\n")[one["nested"].start_line - 1].strip().startswith("fn nested")
    assert D.documented_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize(("doc", "name", "trivial"), [
    (None, "x", True), ("one two three", "x", True), ("one two three four", "x", False), ("Todos are listed here now", "x", True), ("The file of the files", "file", True), ("a_b c d", "x", False),
    ("~~~\na b c d e\n~~~\n", "x", True), ("```\nopen a b c d", "x", True), ("```inline``` code in a line of words", "x", False), ("#no heading but words", "x", False), ("    # indented too far to be one", "x", False), ("The FILES it reads", "read_file", True),
])
def test_trivial(doc, name, trivial):
    assert D.is_trivial(doc, name) is trivial


HAND = "use a::B;\n\n/// Says something.\npub fn f{k}(x: u32) -> u32 {{\n    let y = x + {k};\n    if y > 3 {{ return y; }}\n    call_{k}(y)\n}}\n"
MIN = "!function(a,b){{var c=a[{k}]||b;return c?d(c):e(a)}}(f,g);" * 9
DATA = "pub const T{k}: [u32; 60] = [\n" + "    1, 22, 333, 4444, 5, 66,\n" * 10 + "];\n"


def files_of(spark):
    rows = [(k, f"crates/c{k % 10}/src/a{k}.rs", f"c{k % 10}", HAND.format(k=k)) for k in range(200)]
    rows += [(1000 + k, f"crates/c{k % 10}/web/x{k}.min.js", f"c{k % 10}", MIN.format(k=k)) for k in range(40)]
    rows += [(2000 + k, f"crates/c{k % 10}/web/y{k}.js", f"c{k % 10}", MIN.format(k=500 + k)) for k in range(5)]
    rows += [(3000 + k, f"crates/c{k % 10}/src/t{k}.rs", f"c{k % 10}", DATA.format(k=k)) for k in range(20)]
    copied = "/// Copied.\n" + HAND.format(k=777) * 2
    rows += [(4000, "crates/c1/vendor/p/src/z.rs", "c1", copied), (4001, "crates/c2/src/z.rs", "c2", "// spaced\n" + copied.replace("    ", "  "))]
    own = HAND.format(k=888) * 2
    rows += [(4100, "crates/c1/src/own.rs", "c1", own), (4101, "crates/c2/src/own.rs", "c2", own)]
    rows += [(5000, "crates/c1/src/g.rs", "c1", "// Code generated by x. DO NOT EDIT.\n" + HAND.format(k=5)), (5001, "crates/c1/src/h.rs", "c1", "//! Operators do not edit the table while this runs.\n" + HAND.format(k=6)), (5002, "crates/c1/src/i.rs", "c1", HAND.format(k=7) + "// @generated by y\n")]
    rows += [(5003, "crates/vendor_portal/src/i.rs", "c1", 'static B: &str = "// Code generated by x. DO NOT EDIT.";\n' + HAND.format(k=8))]
    rows += [(6000, "a.rs", "c", None), (6001, "b.rs", "c", " \n"), (None, "c.rs", "c", "x"), (6002, None, None, HAND.format(k=9))]
    return spark.createDataFrame(rows, "file_id long, file_path string, crate string, code string").withColumn("print", F.lit("clash")).withColumn("features", F.lit("clash")).withColumn("generated", F.lit("clash"))


def test_handwritten(spark):
    df = files_of(spark)
    df = df.unionByName(df.where("file_id in (1000, 5000, 3)"))
    kinds = {r.file_id: r for r in H.classify(df).collect()}
    assert len(kinds) == 200 + 40 + 5 + 20 + 4 + 4 + 1
    assert all(kinds[1000 + k].minified for k in range(40)) and all(kinds[3000 + k].data for k in range(20))
    assert sum(kinds[2000 + k].minified for k in range(5)) == 5  # without a telling name
    assert kinds[4000].vendored and kinds[4001].vendored and kinds[4100].handwritten and kinds[4101].handwritten
    assert kinds[5000].generated and kinds[5002].generated and kinds[5001].handwritten and kinds[5003].handwritten and kinds[6002].handwritten
    assert sum(kinds[k].handwritten for k in range(200)) == 200


def test_empty_table(spark):
    assert H.found(files_of(spark).limit(0)).count() == 0


@pytest.mark.parametrize(("code", "data"), [
    ("a;1;x\n" * 9, True), ("a;1\n" * 9, False), ('{"a": [1, 2, 3]}', False), ("const D = [" + '{"a":1},' * 30 + "];", True), ("insert into t values (1, 'x', null);\n" * 20, True), ("create table t (\n a text\n);\n" * 10, False),
    ("const A: [u8; 32] = [" + "1, " * 32 + "];\nfn f() {}\n", False), ("pub const M: &str = \"" + "Ab9+" * 200 + "\";", True), ("", False),
])
def test_is_data(code, data):
    assert H.is_data(code) is data


def test_outer_comments():
    assert H.outer_comments("// a\n/* b\n c */\n#[x]\nfn f() {}\n// z\n") == ("// a\n/* b\n c */", "// z\n")
    assert H.outer_comments("") == ("", "")
