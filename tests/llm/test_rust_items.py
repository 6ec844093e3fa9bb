from tessella.llm.rust_items import RustSource, split_top

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


def test_functions():
    rust = RustSource(CODE)
    assert [f["name"] for f in rust.functions()] == ["hello", "inner", "twice", "from", "new"]
    hello = rust.describe(rust.functions()[0])
    assert hello["doc_comments"] == " Says hello."
    assert (hello["visibility"], hello["is_async"], hello["is_const"]) == ("pub(crate)", True, False)
    assert hello["generic_params"] == ["'a", "T: Into<String>"]
    assert hello["params"] == ["name: &'a str", "x: [u8; { 1 + 2 }]"]
    assert hello["return_type"] == "Result<T, Box<dyn Fn(u32) -> bool>>"
    assert hello["where_clause"] == "T: Clone"
    assert hello["attributes"] == ["#[must_use]"]
    assert hello["full_text"].startswith("pub(crate) async fn hello") and hello["full_text"].endswith("Ok(inner())\n}")
    assert CODE.split("\n")[hello["start_line"] - 1].startswith("pub(crate) async fn")
    new = rust.describe(rust.functions()[4])
    assert new["is_const"] and new["signature"] == "const fn new() -> Self"


def test_odd_texts():
    for code in ("", "\n", "fn", "fn x() {", "}}}} fn ok() {}", '"open string fn x() {}', "/* open fn x() {}", "r#\"open", "#[open", "fn f<", "é fn naïve() {}", "\r\nfn crlf() {}\r\n", "x!(", "'"):
        names = [f["name"] for f in RustSource(code).functions()]
        assert names == {"}}}} fn ok() {}": ["ok"], "é fn naïve() {}": [], "\r\nfn crlf() {}\r\n": ["crlf"]}.get(code, [])


def test_signatures_with_expressions():
    code = "fn a() -> [u8; 1 << 3] { x() }\nfn b<const N: usize = { 1 }>(x: Foo<{ 2 > 1 }>) -> Foo<{ N }> where [(); N]: Sized { }\nunsafe extern \"C\" fn c();\npub(in crate::x) const unsafe extern \"C\" fn d() {}\nfn e(f: fn(u8) -> u8) -> impl Fn() -> u8 + 'static { f }"
    assert [f["name"] for f in RustSource(code).functions()] == ["a", "b", "d", "e"]
    assert RustSource(code).functions()[2]["visibility"] == "pub(in crate::x)"


def test_split_top():
    assert split_top("a, b<c, d>, fn(e, f) -> g,") == ["a", "b<c, d>", "fn(e, f) -> g"]
    assert split_top("") == []


def test_long_ways_back():
    path = "::".join(f"part{k}" for k in range(100))
    assert [f["name"] for f in RustSource(f"{path}::make! {{ fn inside() {{}} }}\nfn outside() {{}}").functions()] == ["outside"]
    assert [f["name"] for f in RustSource("make!();" + " " * 5000 + "fn a() {}\n" + "unsafe " * 40 + "fn b() {}").functions()] == ["a", "b"]
