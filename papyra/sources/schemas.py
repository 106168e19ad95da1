"""Declared schemas of every input. Names the inputs use."""

METADATA_COLUMNS = [
    "cord_uid",
    "sha",
    "source_x",
    "title",
    "doi",
    "pmcid",
    "pubmed_id",
    "license",
    "abstract",
    "publish_time",
    "authors",
    "journal",
    "mag_id",
    "who_covidence_id",
    "arxiv_id",
    "pdf_json_files",
    "pmc_json_files",
    "url",
    "s2_id",
]

# Rank columns as the journal list spells them, in the order they are appended.
RANK_COLUMNS = ["ISSN", "ISSN_key", "Full Journal Title", "Rank", "Journal Impact Factor"]

METADATA = ", ".join(f"`{c}` string" for c in METADATA_COLUMNS)

RANKS = "ISSN string, `Full Journal Title` string, Rank string, `Journal Impact Factor` string"

IDS = "sha string"

RECORD = "DOI string, ISSN array<string>"

ARTICLE = (
    "paper_id string, "
    "metadata struct<authors: array<struct<affiliation: struct<location: struct<country: string>>>>>, "
    "abstract array<struct<text: string>>, "
    "body_text array<struct<text: string>>"
)

CORRUPT = "_corrupt_record"
