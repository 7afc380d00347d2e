"""The jobs from the command line: `python -m plotmill.cli <job> ...`."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plotmill import sinks
from plotmill.constants import CONTINUATION_RATE, DROPPABLE_TAGS, KEY_ORDER, TAG_DROP_RATE, VALIDATION_SHARE
from plotmill.operators import chunking, dataset, fewshot, generation, grid, names, phrases, records, rows, screenplay, tags
from plotmill.session import cut_lineage, get_spark
from plotmill.sources import files
from plotmill.sources.settings import Settings, extend_story_settings, json_file, replacement_lists, template


def chunk_books(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = chunking.book_chunks(files.books(spark, a.folder), "book", "raw", a.max_tokens, a.exclude, a.pieces)
    if a.files:
        sinks.write_chunk_files(chunks, a.out, "book")
    else:
        sinks.write_chunks(chunks, a.out, "book")


def chunk_scripts(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.scripts(spark, a.folder)
    locations, people = (json_file(f) if f else {} for f in (a.locations, a.names))
    chunks = screenplay.screenplay_chunks(found, "script", "text", a.max_tokens, locations)
    if a.files:
        sinks.write_chunk_files(chunks, a.out, "script", "is_roleplay")
    else:
        sinks.write_chunks(chunks, a.out, "is_roleplay")
    met = screenplay.script_constants(found, "text")
    for column, known, name in zip(("location", "name"), (locations, people), ("_locations.json", "_names.json"), strict=True):
        sinks.write_mapping(screenplay.merged_constants(met[column == "name"], column, known), column, "shown", a.out.rstrip("/") + name)


def generate(spark: SparkSession, a: argparse.Namespace) -> None:
    text, params = template(a.template)
    text = fewshot_without(spark, text, params.get("remove_keys_from_prompt", []))
    chunks = files.with_record(files.tree(spark, a.folder))
    if a.done:
        chunks = files.unprocessed(chunks, files.tree(spark, a.done, endings=(".json",)))
    settings = _settings(a)
    rate = settings.get("prompt_gen.continuation_likelyhood", CONTINUATION_RATE)
    model = generation.client(a.back_end, settings.get("completion.url", None), settings.get("completion.preset_name", None))
    answers = cut_lineage(generation.ask_for_chunks(chunks, ["story", "chunk"], text, model, params, a.seed, a.attempts, a.blacklist, rate))
    if a.answers:
        sinks.write_answers(answers, a.answers)
    made = generation.chunk_records(answers, params)
    good = made.filter("reason IS NULL").select("story", files.output_name(F.col("chunk")).alias("chunk"), records.ordered(F.col("prompt"), settings.get("prompt_format.json_key_order", KEY_ORDER)).alias("prompt"))
    sinks.write_records(good, a.out)
    if a.extras:
        sinks.write_extras(good, a.extras)
    sinks.write_rejects(made.filter("reason IS NOT NULL OR size(junk) > 0"), a.out.rstrip("/") + "_rejects")


def _settings(a: argparse.Namespace) -> Settings:
    """The layers of a job: `--settings` over `--defaults`; without either every setting has its default."""
    return Settings.load(a.defaults, a.settings) if a.defaults else Settings({}, Settings.load(a.settings).default if a.settings else {})


def fewshot_without(spark: SparkSession, text: str, keys: list[str]) -> str:
    """A template without some keys."""
    return spark.range(1).select(fewshot.edit(F.lit(text), keys).alias("t")).first()["t"] if keys else text


def count_phrases(spark: SparkSession, a: argparse.Namespace) -> None:
    chunks = files.with_record(files.tree(spark, a.folder))
    text = F.when(F.col("prompt").isNull(), F.col("raw")).otherwise(records.full_text(F.col("prompt")))
    counts = cut_lineage(phrases.story_phrases(chunks.select("story", text.alias("text")), "story", "text"))
    sinks.write_phrases(phrases.frequent_in_story(counts, a.min_repeats), phrases.frequent_overall(counts, a.min_repeats, a.min_stories), a.out)


def randomize(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.with_record(files.tree(spark, a.folder, endings=(".json",))).filter("prompt IS NOT NULL")
    lists = {k: v for k, v in (("male", json_file(a.male) if a.male else None), ("female", json_file(a.female) if a.female else None)) if v}
    renamed = cut_lineage(names.randomize_names(found, ["story", "chunk"], seed=a.seed, **lists))
    sinks.write_records(renamed.withColumn("prompt", records.ordered(F.col("prompt"))), a.out)
    sinks.write_mapping(names.replaced_names(renamed, ["story", "chunk"]), "old_name", "new_name", a.out.rstrip("/") + "_replaced_names.json")


def finalize(spark: SparkSession, a: argparse.Namespace) -> None:
    settings = _settings(a)
    found = files.with_record(files.tree(spark, *a.folders, endings=(".json",))).filter("prompt IS NOT NULL")
    key = ["root", "story", "chunk"]
    if settings.get("hacks.redistribute_authors", False):
        named = found.withColumn("_key", F.concat_ws("/", *key))
        chosen = tags.narrow_authors(named, tags.popularity(named), "_key", seed=a.seed)
        drawn = F.when(F.col("author").isNotNull(), F.create_map(F.lit("author"), F.col("author")))
        found = named.join(chosen, "_key", "left").withColumn("prompt", records.overlay(F.col("prompt"), drawn)).drop("_key", "author")
    if settings.get("hacks.swap_tag_values", False):
        found = found.withColumn("prompt", tags.alias_record(F.col("prompt")))
    prose = settings.get("hacks.use_prose_styles", True) and not a.plain
    made = rows.dataset_rows(found, key, seed=a.seed, prose=prose, rate=settings.get("prompt_format.tag_drop_rate", TAG_DROP_RATE), droppable=settings.get("prompt_format.droppable_tags", DROPPABLE_TAGS))
    made = cut_lineage(dataset.token_range(made, a.min_tokens, a.max_tokens))
    share = settings.get("prompt_format.validation_set_size", VALIDATION_SHARE) if a.validation is None else a.validation
    roots = [os.path.basename(f.rstrip("/")) for f in a.folders]
    os.makedirs(a.out, exist_ok=True)
    for subset in dataset.subsets(roots) if a.all_combinations else [roots]:
        name = dataset.subset_name(subset, a.max_tokens, a.min_tokens)
        part = made.filter(F.col("root").isin(subset)).withColumn("_key", F.concat_ws("/", *key))
        sinks.write_dataset(dataset.exact_split(part, "_key", a.seed, share), a.out, name)
        sinks.write_metrics(dataset.tag_metrics(part), f"{a.out}/{name}_info.json")


def examples(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.books(spark, a.folder)
    sinks.write_records(found.select(F.lit("examples").alias("story"), F.concat("book", F.lit(".json")).alias("chunk"), records.ordered(records.parse_example(F.col("raw"))).alias("prompt")), a.out)


def inject(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.with_record(files.tree(spark, a.folder, endings=(".json",))).filter("prompt IS NOT NULL")
    known = spark.createDataFrame([(s,) for s in json_file(a.settings)], "story string")
    stories = [r["story"] for r in files.new_stories(found, known).collect()]  # those the settings file is to be extended by
    if new := extend_story_settings(a.settings, stories, a.keys):
        raise SystemExit(f"fill in {a.settings} for: {', '.join(sorted(new))}")
    chosen = json_file(a.settings)
    table = spark.createDataFrame([(s, *(v.get(k, "") for k in a.keys)) for s, v in chosen.items()], ", ".join(["story string", *(f"`{k}` string" for k in a.keys)]))
    sinks.write_records(records.inject(found, table, "story", a.keys).withColumn("prompt", records.ordered(F.col("prompt"))), a.out)


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    base, extract = (files.with_record(files.tree(spark, f, endings=(".json",))).filter("prompt IS NOT NULL") for f in (a.folder, a.extract))
    if n := records.unmatched(base, extract, ["story", "chunk"]).count():
        raise SystemExit(f"{n} records have no partner in {a.extract}")
    sinks.write_records(records.merge_records(base, extract, ["story", "chunk"], a.keys), a.out)


def test_template(spark: SparkSession, a: argparse.Namespace) -> None:
    cells = grid.template_grid(spark, template(a.template)[0], replacement_lists(a.template), a.trials)
    if (done := sinks.tested(spark, a.out)) is not None:
        cells = cells.join(cut_lineage(done), "out_file", "left_anti")
    answers = generation.ask(cells, ["out_file", "prompt"], "prompt", generation.client(a.back_end), 1, ["### System:", "### User:", "### Assistant:"], 0.8, a.response_length)
    sinks.write_results(answers.withColumn("result", F.coalesce("answer", F.lit(""))), a.out)


def stories(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.with_record(files.tree(spark, a.folder))
    text = F.when(F.col("prompt").isNull(), F.col("raw")).otherwise(F.col("prompt")["story"])
    sinks.write_stories(files.shuffled(found.select(F.concat_ws("/", "story", "chunk").alias("key"), text.alias("text")), "key", a.seed).select(F.col("text").alias("story")), a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="plotmill", description=__doc__)
    jobs = p.add_subparsers(required=True)

    def job(f, *arguments) -> None:  # noqa: ANN001
        sub = jobs.add_parser(f.__name__.replace("_", "-"))
        for names_, options in arguments:
            sub.add_argument(*names_, **options)
        sub.set_defaults(run=f)

    folder, out = (("folder",), {}), (("out",), {})
    tokens, seed = (("--max-tokens",), {"type": int, "required": True}), (("--seed",), {"type": int, "default": 42})
    back_end = (("--back-end",), {"default": "stub", "choices": sorted(generation.BACK_ENDS)})
    keys = (("--keys",), {"nargs": "+", "required": True})
    as_files = (("--files",), {"action": "store_true"})
    settings = (("--settings",), {}), (("--defaults",), {})
    job(chunk_books, folder, out, tokens, (("--exclude",), {"action": "store_true"}), (("--pieces",), {"help": "a SentencePiece model whose pieces are counted"}), as_files)
    job(chunk_scripts, folder, out, tokens, (("--locations",), {}), (("--names",), {}), as_files)
    job(generate, folder, out, seed, back_end, *settings, (("--answers",), {}), (("--extras",), {}), (("--template",), {"required": True}), (("--done",), {}), (("--attempts",), {"type": int, "default": 3}), (("--blacklist",), {"nargs": "*", "default": []}))
    job(count_phrases, folder, out, (("--min-repeats",), {"type": int, "default": phrases.LEAST_IN_STORY}), (("--min-stories",), {"type": int, "default": phrases.LEAST_STORIES}))
    job(randomize, folder, out, seed, (("--male",), {}), (("--female",), {}))
    job(
        finalize, (("folders",), {"nargs": "+"}), (("--out",), {"required": True}), seed, (("--max-tokens",), {"type": int}), (("--min-tokens",), {"type": int}),
        (("--all-combinations",), {"action": "store_true"}), (("--plain",), {"action": "store_true"}), (("--validation",), {"type": float}), *settings,
    )
    job(examples, folder, out)
    job(inject, folder, out, keys, (("--settings",), {"required": True}))
    job(merge, folder, out, keys, (("--extract",), {"required": True}))
    job(test_template, (("--template",), {"required": True}), out, back_end, (("--trials",), {"type": int, "default": 1}), (("--response-length",), {"type": int, "default": 600}))
    job(stories, folder, out, seed)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(spark or get_spark(), a)


if __name__ == "__main__":
    main()
