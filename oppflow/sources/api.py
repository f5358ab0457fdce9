"""REST payloads -> raw records.

A normaliser takes landed response bodies ``(payload_ord bigint, body string)``,
parses them with an explicit schema and projects the raw-record columns.
``payload_ord`` and ``item_ord`` say where a record came from, so that "first one
wins" has a fixed meaning after any shuffle.  ``payload_ord`` is whatever sorts: a number, or the text that ``read_bodies`` makes.  Every leaf is read as text: amounts
keep the digits they were sent with.
"""
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oppflow.fixed_values import OPEN_DATA_SETS
from oppflow.functions.scalars import blank_to_null, first_filled, first_nonempty, place
from oppflow.operators.identity import first_wins
from oppflow.schema import raw_record

ORDER = ["payload_ord", "item_ord"]


def read_bodies(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Landed responses, one per file (or per line), in order of their place.

    The place is the number in the file's name, then its path, then the offset in the file, as one text that sorts so; no
    two responses share it.  A line's offset is that of its split and the order in which the split is read.
    What the landing folders are named by, such as ``award_group=Grants``, comes along as columns.
    """
    bodies = spark.read.text(path, wholetext=whole_files)

    def padded(number: Column) -> Column:
        return F.lpad(number.cast("string"), 20, "0")

    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{1,18})", 1).try_cast("bigint")
    place = F.concat_ws(
        "/", padded(F.coalesce(number, F.lit(0))), F.col("_metadata.file_path"),
        padded(F.col("_metadata.file_block_start")), padded(F.monotonically_increasing_id()))
    return bodies.select(place.alias("payload_ord"), F.col("value").alias("body"), *[c for c in bodies.columns if c != "value"])


def _struct(leaves: str, nested: str = "") -> str:
    fields = [f"`{name.strip()}`: string" for name in leaves.split(",")]
    return f"struct<{', '.join(fields + ([nested] if nested else []))}>"


def _items(bodies: DataFrame, schema: str, where: Column) -> DataFrame:
    parsed = bodies.select("payload_ord", F.from_json("body", schema).alias("p"))
    return parsed.select("payload_ord", F.posexplode(where).alias("item_ord", "r"))


def _items_or_list(bodies: DataFrame, item: str, envelope: str, *where: str) -> DataFrame:
    """Items under one of several envelope fields, or a bare list."""
    parsed = bodies.select(
        "payload_ord",
        F.from_json("body", envelope).alias("p"),
        F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{item}>")).alias("bare"),
    )
    found = F.coalesce("bare", *[F.expr(w) for w in where])
    return parsed.select("payload_ord", F.posexplode(found).alias("item_ord", "r"))


def _r(name: str) -> Column:
    return F.col(f"r.`{name}`")


def _any(*names: str) -> Column:
    return F.coalesce(*[_r(n) for n in names])


# ---------------------------------------------------------------- federal
def sam_gov(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "noticeId,title,fullParentPathName,department,type,postedDate,responseDeadLine,uiLink,"
        "description,estimatedValue,baseAndAllOptionsValue,totalEstimatedContractValue,amount",
        "award: struct<amount: string>",
    )
    rows = _items(bodies, f"opportunitiesData array<{item}>", F.col("p.opportunitiesData"))
    return raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("SAM.gov"),
        id=_r("noticeId"), title=_r("title"), agency=_any("fullParentPathName", "department"),
        status=_r("type"), posted_date=_r("postedDate"), close_date=_r("responseDeadLine"),
        url=_r("uiLink"), description=F.left(_r("description"), F.lit(1000)),
        amount=first_filled(
            F.col("r.award.amount"), _r("estimatedValue"), _r("baseAndAllOptionsValue"),
            _r("totalEstimatedContractValue"), _r("amount"),
        ),
    )


def grants_gov(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "id,number,oppNumber,title,oppTitle,agency,agencyName,oppStatus,openDate,postDate,closeDate,"
        "deadline,description,synopsis,awardCeiling,estimatedTotalProgramFunding,awardFloor,"
        "totalFundingAmount,estimatedFunding,ceiling,amount"
    )
    rows = _items_or_list(
        bodies, item, f"data struct<oppHits: array<{item}>>, oppHits array<{item}>",
        "p.data.oppHits", "p.oppHits",
    )
    opp_id = F.coalesce(_any("id", "number", "oppNumber"), F.lit(""))
    raw = raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("Grants.gov"),
        id=opp_id, title=_any("title", "oppTitle"), agency=_any("agency", "agencyName"),
        status=F.coalesce(_r("oppStatus"), F.lit("Posted")),
        posted_date=_any("openDate", "postDate"), close_date=_any("closeDate", "deadline"),
        url=F.when(opp_id != "", F.concat(F.lit("https://www.grants.gov/search-results-detail/"), opp_id)),
        description=F.left(_any("description", "synopsis", "title"), F.lit(1000)),
        amount=first_filled(
            _r("awardCeiling"), _r("estimatedTotalProgramFunding"), _r("awardFloor"),
            _r("totalFundingAmount"), _r("estimatedFunding"), _r("ceiling"), _r("amount"),
        ),
    )
    return first_wins(raw, ["id"], ORDER)


def sbir(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "solicitation_number,solicitationId,id,solicitation_title,solicitationTitle,title,"
        "sbir_solicitation_link,sbpiUrl,url,current_status,status,agency,open_date,openDate,postedDate,"
        "close_date,closeDate,deadline,sbir_solicitation_agency_url,description"
    )
    rows = _items_or_list(
        bodies, item, f"results array<{item}>, data array<{item}>", "p.results", "p.data"
    )
    sol_id = F.coalesce(_any("solicitation_number", "solicitationId", "id"), F.lit(""))
    link = blank_to_null(_any("sbir_solicitation_link", "sbpiUrl", "url"))
    return raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("SBIR.gov"), id=sol_id,
        title=_any("solicitation_title", "solicitationTitle", "title"), agency=_r("agency"),
        status=first_nonempty(_any("current_status", "status"), F.lit("Open")),
        posted_date=_any("open_date", "openDate", "postedDate"),
        close_date=_any("close_date", "closeDate", "deadline"),
        url=F.coalesce(link, F.when(sol_id != "", F.concat(F.lit("https://www.sbir.gov/node/"), sol_id))),
        description=F.left(_any("sbir_solicitation_agency_url", "description"), F.lit(500)),
    )


def nih_reporter(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "project_num,project_title,award_amount,total_cost,project_start_date,project_end_date,abstract_text",
        "agency_ic_fundings: array<struct<abbreviation: string>>, "
        "principal_investigators: array<struct<full_name: string, first_name: string, last_name: string>>, "
        "organization: struct<org_name: string, org_city: string, org_state: string>",
    )
    rows = _items(bodies, f"results array<{item}>", F.col("p.results"))
    number = F.coalesce(_r("project_num"), F.lit(""))
    names = F.filter(
        F.transform(
            F.coalesce(_r("principal_investigators"), F.array()),
            lambda p: first_nonempty(
                p["full_name"], F.trim(F.concat_ws(" ", p["first_name"], p["last_name"]))
            ),
        ),
        lambda name: name != "",
    )
    institute = F.coalesce(F.get(_r("agency_ic_fundings"), 0)["abbreviation"], F.lit("NIH"))
    raw = raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("NIH RePORTER"), id=number,
        title=_r("project_title"), agency=F.concat(F.lit("NIH / "), institute), status=F.lit("Active"),
        posted_date=_r("project_start_date"), close_date=_r("project_end_date"),
        url=F.when(number != "", F.concat(F.lit("https://reporter.nih.gov/project-details/"), number)),
        description=F.left(_r("abstract_text"), F.lit(500)),
        amount=first_filled(_r("award_amount"), _r("total_cost")),
        recipient=F.col("r.organization.org_name"),
        recipient_state=place(F.col("r.organization.org_city"), F.col("r.organization.org_state")),
        pi_name=F.array_join(F.slice(names, 1, 3), "; "),
    )
    return first_wins(raw, ["id"], ORDER)


def nsf_awards(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "id,title,agency,startDate,expDate,estimatedTotalAmt,abstractText,piFirstName,piLastName,"
        "awardeeName,awardeeCity,awardeeStateCode"
    )
    rows = _items(bodies, f"response struct<award: array<{item}>>", F.col("p.response.award"))
    award_id = F.coalesce(_r("id"), F.lit(""))
    raw = raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("NSF Awards"), id=award_id, title=_r("title"),
        agency=F.concat(F.lit("NSF — "), F.coalesce(_r("agency"), F.lit("NSF"))), status=F.lit("Awarded"),
        posted_date=_r("startDate"), close_date=_r("expDate"),
        url=F.when(award_id != "", F.concat(F.lit("https://www.nsf.gov/awardsearch/showAward?AWD_ID="), award_id)),
        description=F.left(_r("abstractText"), F.lit(500)),
        amount=first_filled(_r("estimatedTotalAmt")),
        recipient=_r("awardeeName"), recipient_state=place(_r("awardeeCity"), _r("awardeeStateCode")),
        pi_name=F.trim(F.concat_ws(" ", _r("piFirstName"), _r("piLastName"))),
    )
    return first_wins(raw, ["id"], ORDER)


def federal_register(bodies: DataFrame) -> DataFrame:
    item = _struct(
        "document_number,title,publication_date,abstract,html_url", "agencies: array<struct<name: string>>"
    )
    rows = _items(bodies, f"results array<{item}>", F.col("p.results"))
    raw = raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("Federal Register"), id=_r("document_number"),
        title=_r("title"), agency=F.get(_r("agencies"), 0)["name"], status=F.lit("Notice"),
        posted_date=_r("publication_date"), url=_r("html_url"),
        description=F.left(_r("abstract"), F.lit(500)),
    )
    return first_wins(raw, ["id"], ORDER)


def usaspending(bodies: DataFrame) -> DataFrame:
    """Bodies carry ``award_group``: Contracts or Grants."""
    item = _struct(
        "Award ID,Recipient Name,Description,Start Date,End Date,Award Amount,Awarding Agency,"
        "generated_internal_id,Recipient State Code,Recipient City Name"
    )
    parsed = bodies.select(
        "payload_ord", "award_group", F.from_json("body", f"results array<{item}>").alias("p")
    )
    rows = parsed.select("payload_ord", "award_group", F.posexplode("p.results").alias("item_ord", "r"))
    internal = blank_to_null(_r("generated_internal_id"))
    return raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.format_string("USAspending (%s)", F.col("award_group")),
        id=_any("Award ID", "generated_internal_id"), title=_r("Description"),
        agency=_r("Awarding Agency"), status=F.lit("Awarded"),
        posted_date=_r("Start Date"), close_date=_r("End Date"),
        url=F.concat(F.lit("https://www.usaspending.gov/award/"), internal),
        description=F.left(_r("Description"), F.lit(500)), amount=first_filled(_r("Award Amount")),
        recipient=_r("Recipient Name"),
        recipient_state=place(_r("Recipient City Name"), _r("Recipient State Code")),
    )


def propublica(bodies: DataFrame) -> DataFrame:
    item = _struct("ein,name,ntee_code,city,state,score")
    # the first twenty organisations of each response are the feature, not a cap
    rows = _items(bodies, f"organizations array<{item}>", F.slice("p.organizations", 1, 20))
    ein = F.coalesce(_r("ein"), F.lit(""))
    raw = raw_record(
        rows, ORDER,
        state=F.lit("Federal"), source=F.lit("ProPublica Nonprofits"), id=ein, title=_r("name"),
        agency=place(_r("city"), _r("state")), status=F.lit("Active Org"),
        url=F.when(ein != "", F.concat(F.lit("https://projects.propublica.org/nonprofits/organizations/"), ein)),
        description=F.concat(
            F.lit("NTEE: "), F.coalesce(_r("ntee_code"), F.lit("")),
            F.lit(" | Score: "), F.coalesce(_r("score"), F.lit("")),
        ),
    )
    return first_wins(raw, ["id"], ORDER)


# ------------------------------------------------------------- open data
def open_data(rows: DataFrame, state: str, since: str | None = None) -> DataFrame:
    """One flat open-data set; each field comes from the first filled candidate column.

    ``since`` keeps rows from that date text on, where the set has a date column.
    """
    config = OPEN_DATA_SETS[state]
    present = set(rows.columns)

    def pick(field: str) -> Column:
        return first_nonempty(*[F.col(c).cast("string") for c in config[field] if c in present])

    dated = next((c for c in config["date"] if c in present), None)
    if since and dated:
        rows = rows.filter(F.col(dated) >= F.lit(since))
    title = pick("title")
    return raw_record(
        rows, [c for c in ORDER if c in present],
        state=F.lit(state), source=F.lit(f"{config['label']} (Awarded)"),
        id=pick("id"), title=title, agency=pick("agency"), status=F.lit("Awarded"),
        posted_date=F.col(dated) if dated else F.lit(""), close_date=pick("end_date"),
        description=F.left(title, F.lit(1000)), amount=pick("amount"),
    )
