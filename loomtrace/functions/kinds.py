"""What a value is: kinds of parameters and their canonical text, tokens, answers that say something,
classes of names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of truth values, answers that only report progress, and how refusals begin.
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
PROCESS_ONLY = ("analysis complete", "analysis completed", "completed", "completed successfully", "done", "task complete", "task completed")
REFUSALS = ("i cannot ", "i can't ", "unable to ", "no result")
# Words in a parameter's name that tell the kind of its text.
PATH_WORDS = ("path", "file", "dir", "folder", "artifact")

#: Classes of kernels by what their lower-cased names contain; the first that holds counts.
KERNELS = (
    ("nccl", "NCCL Communication"), ("deep_ep&dispatch", "DeepEP Dispatch (MoE)"), ("deep_ep&combine", "DeepEP Combine (MoE)"), ("deep_ep&clean", "DeepEP Buffer Clean"),
    ("deep_ep", "DeepEP (other)"), ("flash&attn", "Flash Attention"), ("sparse_attn", "Sparse Attention (MLA)"), ("paged_mqa", "Paged MQA/MLA Logits"),
    ("attention|fmha", "Attention (other)"), ("deep_gemm|sm90_fp8_gemm", "DeepGEMM (FP8)"), ("nvjet", "NvJet GEMM"), ("gemm|cutlass|matmul|cublas", "GEMM/MatMul (other)"),
    ("topk", "TopK / MoE Routing"), ("quant", "Quantization (FP8)"), ("norm", "Normalization"), ("triton|fused", "Fused/Triton Kernels"), ("elementwise", "Elementwise Ops"),
    ("reduce|softmax", "Reduce/Softmax"), ("embedding", "Embedding"), ("memcpy|memset", "Memory Ops"), ("index|scatter|gather", "Index/Gather/Scatter"), ("cat&batched", "Concat/Cat"),
)


def truth(value: Column) -> Column:
    """A truth value's spelling as boolean; null for other text."""
    word = F.lower(F.trim(value))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def value_kind(name: Column, value: Column, declared: Column | None = None) -> Column:
    """The kind of a text value: as declared, else bool, number, or by words of the parameter's name
    (smiles, artifact), else string. Null values are strings."""
    named = F.lower(F.coalesce(name, F.lit("")))
    by_name = F.when(F.contains(named, F.lit("smiles")), "smiles").when(named.rlike("|".join(PATH_WORDS)), "artifact").otherwise("string")
    found = F.when(value.isNull(), "string").when(truth(value).isNotNull(), "bool").when(F.trim(value).try_cast("double").isNotNull(), "number").otherwise(by_name)
    return found if declared is None else F.coalesce(declared, found)


def canonical_value(value: Column, kind: Column, path_parts: int = 2) -> Column:
    """A value's text in the one spelling of its kind: truth values as true and false, numbers rounded
    to six places, SMILES without white space, paths by their last parts, other text with single spaces."""
    number = F.round(F.trim(value).try_cast("double"), 6).cast("string")
    parts = F.filter(F.split(F.trim(value), r"[/\\]"), lambda x: x != "")
    path = F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - path_parts + 1), F.lit(path_parts)), "/")
    return (
        F.when(kind == "bool", F.coalesce(truth(value), F.length(value) > 0).cast("string")).when(kind == "number", F.coalesce(number, F.trim(value)))
        .when(kind == "smiles", F.regexp_replace(value, r"\s+", "")).when(kind == "artifact", path).otherwise(F.trim(F.regexp_replace(value, r"\s+", " ")))
    )


def structural_token(token: Column) -> Column:
    """Whether a token may be a structure's notation: some letter, and not only letters and underscores."""
    t = F.trim(token)
    return F.coalesce(t.rlike("[A-Za-z]") & ~t.rlike("^[A-Za-z_]+$") & t.rlike(r"[\[\]()=#@\\/+\-.0-9]"), F.lit(False))


def says_something(answer: Column) -> Column:
    """Whether an answer is more than blank, a report of progress or a refusal."""
    t = F.lower(F.trim(F.regexp_replace(F.coalesce(answer, F.lit("")), r"\s+", " ")))
    refused = F.lit(False)
    for r in REFUSALS:
        refused = refused | F.startswith(t, F.lit(r))
    return (t != "") & ~t.isin(*PROCESS_ONLY) & ~refused


def answer_reasons(answer: Column, parse_error: Column, fields: Column, required: tuple[str, ...] = ()) -> Column:
    """Why a free answer doesn't count: array of codes. ``fields`` is the map of its named parts, null if it has none."""
    present = F.trim(F.coalesce(answer, F.lit(""))) != ""
    lacking = F.filter(F.array(*[F.lit(r) for r in required]), lambda r: F.trim(F.coalesce(F.element_at(fields, r), F.lit(""))) == "")
    structure = (
        F.when(fields.isNull(), "required_final_structure_missing").when(F.size(lacking) > 0, F.concat(F.lit("missing_required_final_fields:"), F.array_join(lacking, ",")))
        if required else F.lit(None).cast("string")
    )
    codes = [F.when(parse_error, "parse_error"), F.when(~present, "empty_prediction"), F.when(present & ~says_something(answer), "missing_result_content"), structure]
    return F.array_compact(F.array(*codes))


def single_answer(predicted: Column, expected: Column) -> Column:
    """struct(acc, reasons) of answers that shall be one value each, arrays of canonical texts."""
    codes = []
    for values, name in ((predicted, "prediction"), (expected, "ground_truth")):
        codes.append(F.when(F.size(values) == 0, f"empty_{name}").when(F.size(values) > 1, F.concat(F.lit(f"invalid_{name}_count:"), F.size(values).cast("string"))))
    right = (F.size(predicted) > 0) & (F.size(expected) > 0) & F.coalesce(F.get(predicted, 0) == F.get(expected, 0), F.lit(False))
    return F.struct(right.cast("double").alias("acc"), F.array_compact(F.array(*codes)).alias("reasons"))


def kernel_class(name: Column, rules: tuple[tuple[str, str], ...] = KERNELS, other: str = "Other Compute") -> Column:
    """The class of the first rule whose words the name has: ``a&b`` both, ``a|b`` either."""
    low, out = F.lower(name), None
    for words, label in rules:
        has = [F.contains(low, F.lit(w)) for w in words.replace("|", "&").split("&")]
        hit = has[0]
        for h in has[1:]:
            hit = hit & h if "&" in words else hit | h
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(other)


def candidates(*sources: tuple[str, Column]) -> Column:
    """Answer candidates in order of preference, as array of struct(source, text): texts or arrays of
    texts, trimmed, blank ones left out, each pair once."""
    def of(name: str, texts: Column) -> Column:
        told = F.filter(F.transform(texts, F.trim), lambda t: t.isNotNull() & (t != ""))
        return F.transform(told, lambda t: F.struct(F.lit(name).alias("source"), t.alias("text")))

    lists = [of(name, texts) for name, texts in sources]
    return F.array_distinct(F.concat(*lists))


def question_text(fields: Column, keys: tuple[str, ...] = ("question", "question_text", "prompt", "public_question_text"), raw: str = "raw_question_json", denied: tuple[str, ...] = ()) -> Column:
    """The question in a map of strings: the first key that isn't blank, else the raw text where it is
    a JSON string, else the map as JSON without the raw text and denied keys."""
    told = [F.nullif(F.trim(F.element_at(fields, F.lit(k))), F.lit("")) for k in keys]
    text = F.nullif(F.trim(F.try_variant_get(F.try_parse_json(F.element_at(fields, F.lit(raw))), "$", "string")), F.lit(""))
    plain = F.when(F.startswith(F.trim(F.element_at(fields, F.lit(raw))), F.lit('"')), text)
    rest = F.map_filter(fields, lambda k, _: ~F.lower(F.trim(k)).isin(raw, *denied))
    return F.coalesce(*told, plain, F.when(F.size(rest) > 0, F.to_json(rest)), F.lit(""))


def labels_of(outer: Column, inner: Column, keys: tuple[str, ...]) -> Column:
    """The label keys of two maps of strings, the outer one's winning."""
    own = lambda m: F.map_filter(F.coalesce(m, F.create_map().cast("map<string,string>")), lambda k, _: F.lower(F.trim(k)).isin(*keys))
    extra = F.map_filter(own(inner), lambda k, _: ~F.map_contains_key(own(outer), k))
    return F.map_concat(own(outer), extra)
