from tessella.functions import rust_patterns as R
from tessella.operators import rust_facts

CODE = '''
use std::fmt::{self, Display};
pub use crate::one::Two;

/// Says hello.
#[must_use]
/* plain */
pub(crate) async fn hello<'a, T: Into<String>>(name: &'a str, x: [u8; { 1 + 2 }]) -> Result<T, Box<dyn Fn(u32) -> bool>>
where
    T: Clone,
{
    let brace = '{'; let s = "fn not_me() {"; let r = r#"} "quoted" fn nor_me() {}"#;
    /* fn hidden() {} /* nested } */ */
    other::call(1).method::<u8>(2);
    println!("fn macro_text() {{");
    direct();
    fn inner() -> u8 { 3 }
    Ok(inner())
}

macro_rules! make { ($n:ident) => { fn $n() {} }; }
make! { fn inside() {} }

#[derive(Debug, Clone)]
#[serde(rename_all = "lowercase")]
pub struct Point<T> { x: T }
enum Kind { A, B }
pub trait Shape: Display + Clone { type Unit; fn area(&self) -> f64; fn twice(&self) -> f64 { 2.0 } }
impl<T> From<Point<T>> for Kind where T: Copy { fn from(_: Point<T>) -> Self { for _ in 0..1 {} Kind::A } }
impl Kind { const fn new() -> Self { if !(true) { Kind::A } else { Kind::B } } }
extern "C" { fn outside(x: i32) -> i32; }
type Callback = fn(i64) -> i64;
'''


ODD = ["", "\n", "fn", "fn x() {", '"open string fn x() {}', "/* open fn x() {}", 'r#"open', "#[open", "fn f<", "x!(", "'", rust_facts.MARK, None]


def read(spark):
    rows = [(1, "a.rs", CODE), (1000, "a.py", "fn no() {}")] + [(10 + k, f"{k}.rs", x) for k, x in enumerate(ODD)] + [(50, "b.rs", "}}}} fn ok() {}"), (51, "c.rs", "\r\nfn crlf() {}\r\n"), (52, "d.rs", "/* a /* b */ fn no() {} */ é fn no() {}\nfn yes() { " + rust_facts.MARK + " }")]
    return rust_facts.read(spark.createDataFrame(rows, "file_id long, file_path string, code string").withColumn("text", rust_facts.F.lit("clash")))


def test_functions(spark):
    rows = rust_facts.functions(read(spark)[2]).orderBy("file_id", "open").collect()
    assert [(r.file_id, r.name) for r in rows] == [(1, "hello"), (1, "inner"), (1, "twice"), (1, "from"), (1, "new"), (50, "ok"), (51, "crlf"), (52, "yes")]
    hello, new = rows[0], rows[4]
    assert hello.doc_comments == " Says hello." and (hello.visibility, hello.is_async, hello.is_const) == ("pub(crate)", True, False)
    assert hello.generics == "<'a, T: Into<String>>" and hello.params == "(name: &'a str, x: [u8; { 1 + 2 }])"
    assert hello.return_type == "Result<T, Box<dyn Fn(u32) -> bool>>" and hello.where_clause == "T: Clone," and hello.attributes == "#[must_use]"
    assert hello.full_text.startswith("pub(crate) async fn hello") and hello.full_text.endswith("Ok(inner())\n}")
    assert CODE.split("\n")[hello.start_line - 1].startswith("pub(crate) async fn") and CODE.split("\n")[hello.end_line - 1] == "}"
    assert new.is_const and new.signature == "const fn new() -> Self" and (rows[3].trait_name, rows[3].for_type, new.for_type) == ("From<Point<T>>", "Kind", "Kind")


def test_facts(spark):
    lex, ev, items = read(spark)
    lex, ev, items = (x.where("file_id = 1") for x in (lex, ev, items))
    calls = rust_facts.calls(lex, ev, items).where("caller_name = 'hello'").orderBy("pos").collect()
    assert [(c.callee_name, c.call_kind) for c in calls] == [("call", "scoped"), ("method", "method"), ("direct", "direct"), ("Ok", "direct"), ("inner", "direct")]
    assert calls[0].qualified == "other::call" and calls[0].call_line == 14
    impls = rust_facts.with_methods(rust_facts.impls(items), items).orderBy("line").collect()
    assert [(x.trait_name, x.for_type, x.methods, x.generics, x.where_clause) for x in impls] == [("From<Point<T>>", "Kind", ["from"], "<T>", "T: Copy"), (None, "Kind", ["new"], "", None)]
    types = rust_facts.types(items).orderBy("line").collect()
    assert [(t.kind, t.name, t.derives, t.serde_attrs) for t in types] == [("struct", "Point", ["Debug", "Clone"], ['rename_all = "lowercase"']), ("enum", "Kind", [], [])]
    trait = rust_facts.traits(items).first()
    assert (trait["name"], trait.super_traits, trait.methods, trait.associated_types) == ("Shape", "Display + Clone", ["area", "twice"], "Unit")
    assert [(i.path, i.is_pub) for i in rust_facts.imports(items).orderBy("line").collect()] == [("std::fmt::{self, Display}", False), ("crate::one::Two", True)]
    assert [(m["name"], m.kind) for m in rust_facts.macros(lex, ev).orderBy("line").collect()] == [("println", "call"), ("make", "definition"), ("make", "call")]
    assert rust_facts.attributed_enums(items, "derive(").count() == 0


def test_attributes(spark):
    code = '#[derive(Clone)]\n// #[no]\n/// Says.\n#[stored(storage_type = "te[x]t", of = [1])]\npub enum E { A }\n#[derive(Debug)]\nenum F { B }\nenum G {}\n#[derive(Clone)] struct H;'
    _, _, items = rust_facts.read(spark.createDataFrame([(1, "a.rs", code)], "file_id long, file_path string, code string"))
    found = rust_facts.attributed_enums(items, "derive(").orderBy("line").collect()
    assert [(r["name"], r.line, r.attribute, r.storage_type) for r in found] == [("E", 5, "#[derive(Clone)]", "te[x]t"), ("F", 7, "#[derive(Debug)]", None)]
    assert [(r["name"], r.derives, len(r.attributes)) for r in rust_facts.types(items).orderBy("line").collect()] == [("E", ["Clone"], 2), ("F", ["Debug"], 1), ("G", [], 0), ("H", ["Clone"], 1)]


def test_patterns():
    code = "/// Doc.\n#[x]\npub fn one(a: u8) -> u8 {\n    if a > 0 { 1 } else { 2 }\n}\nstruct S;\npub struct T { a: u8 }\nimpl T {\n    fn m() {}\n    pub fn n() {}\n}\nimpl Clone for T {\n    fn clone() {}\n}\n"
    assert [f["code"] for f in R.functions(code)][0].endswith("}\n}")
    assert [(x["kind"], x["name"]) for x in R.structs_and_impls(code)] == [("struct", "S"), ("struct", "T"), ("impl", "T"), ("impl", "Clone")]
    items = R.by_line(code)
    assert [(x["kind"], x["name"], x["count"]) for x in items if x["kind"] in ("struct", "impl")] == [("struct", "S", 0), ("struct", "T", 2), ("impl", "T", 2), ("impl", "T", 0 + 1)]
    one = next(x for x in items if x["name"] == "one")
    assert (one["doc"], one["is_public"], one["line"]) == ("Doc.", True, 3)
    assert R.block_end("a { b { } ", 0) is None
