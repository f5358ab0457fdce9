"""Fixed values that results depend on.

Everything here is data, not logic: word lists, lookup tables, limits and
patterns whose exact content decides what a query returns.  The keyword
dictionary itself is a parameter (several hundred phrases that belong to the
user); load it with ``oppflow.functions.phrases.load_phrases``.
"""

# --- fixed values: stop words, everyday English ---------------------------
ENGLISH_STOP_WORDS = """
a an the and or but in on at to for of is it its by from with as be was
were been being have has had do does did will would shall should may might
can could this that these those am are not no nor so if then than too very
each every all any both few more most other some such only own same just
about above after again against before below between during into out over
through under until up also how what which who whom why where when there
here their them they he she her his him we our us you your me my
""".split()

# --- fixed values: stop words, procurement boilerplate --------------------
PROCUREMENT_STOP_WORDS = """
rfp rfq rfi ifb solicitation bid bids proposal proposals contract contracts
amendment addendum addenda vendor vendors supplier suppliers bidder bidders
services service provide providing provided provision procurement purchase
purchasing request requests notice notices invitation invitations due date
state county city town village district department dept division office
agency bureau board commission authority university college school
number num fiscal year month annual quarterly per new open closed awarded
public issued release released issuing response responses submission
submit submitted deadline period effective expiration renewal
section item items page pages attachment exhibit appendix scope work
required requirements requirement include includes including included
shall must may general description specifications specification
""".split()

STOP_WORDS = sorted(set(ENGLISH_STOP_WORDS) | set(PROCUREMENT_STOP_WORDS))

# --- fixed values: a record with one of these anywhere never matches ------
EXCLUSIONS = """
conference|forum|symposium|summit|seminar|workshop|expo|gala|banquet|luncheon
construction|paving|roofing|hvac|plumbing|electrical services
fencing|mowing|janitorial|custodial
sewing|textile|fabric|lining|tape
ambulance|fire truck|tractor|mower
food service|catering|cheese|meat|produce
engineering services|civil engineering|structural engineering
mechanical engineering|geotechnical engineering|engineering design
engineering firm|architecture and engineering|A/E services
surveying services|land surveying|topographic survey
inspection services|materials testing
""".strip().replace("\n", "|").split("|")

# --- fixed values: states, code, name, population in millions -------------
STATES = [
    tuple(line.split(","))
    for line in """
AL,Alabama,5.14
AK,Alaska,0.74
AZ,Arizona,7.58
AR,Arkansas,3.07
CA,California,38.97
CO,Colorado,5.91
CT,Connecticut,3.62
DE,Delaware,1.03
FL,Florida,22.97
GA,Georgia,11.10
HI,Hawaii,1.44
ID,Idaho,2.04
IL,Illinois,12.55
IN,Indiana,6.90
IA,Iowa,3.22
KS,Kansas,2.95
KY,Kentucky,4.54
LA,Louisiana,4.60
ME,Maine,1.40
MD,Maryland,6.24
MA,Massachusetts,7.11
MI,Michigan,10.04
MN,Minnesota,5.77
MS,Mississippi,2.94
MO,Missouri,6.21
MT,Montana,1.14
NE,Nebraska,2.00
NV,Nevada,3.28
NH,New Hampshire,1.41
NJ,New Jersey,9.50
NM,New Mexico,2.13
NY,New York,19.57
NC,North Carolina,10.87
ND,North Dakota,0.79
OH,Ohio,11.78
OK,Oklahoma,4.05
OR,Oregon,4.24
PA,Pennsylvania,12.96
RI,Rhode Island,1.10
SC,South Carolina,5.45
SD,South Dakota,0.92
TN,Tennessee,7.13
TX,Texas,30.86
UT,Utah,3.47
VT,Vermont,0.65
VA,Virginia,8.72
WA,Washington,7.91
WV,West Virginia,1.77
WI,Wisconsin,5.91
WY,Wyoming,0.58
""".strip().splitlines()
]

# --- fixed values: digest sections, in the order they are shown -----------
DIGEST_ORDER = "Federal TX NY CA FL IL PA OH GA NC MI NJ VA WA AZ MA TN IN MO MD".split()

# --- fixed values: limits -------------------------------------------------
VOCABULARY_SIZE = 5000
MIN_DOCUMENTS_PER_TERM = 2
MAX_DOCUMENT_SHARE = 0.85
TOP_TERMS = 50
TOP_TERMS_PER_GROUP = 20
TOP_PHRASES = 50
TOP_GAPS = 30
MIN_GROUP_ROWS = 5
MIN_PHRASE_TEXT = 80
MIN_GAP_SCORE = 0.001
KEY_TERMS_PER_RECORD = 10
SEEN_DAYS = 90
SEEN_DAYS_BACKFILL = 36500
PAGE_ROWS = 100

# --- fixed values: link and noise words on portal pages -------------------
PORTAL_LINK_FRAGMENTS = "solicitation bid opportunity Solicitation Bid rfp procurement contract".split()
NAVIGATION_WORDS = "home login register about contact faq help search back menu".split()
BUYSPEED_NOISE = [
    "select category", "bid solicitations", "contracts", "purchase orders",
    "search", "filter", "sort by", "category",
]

# --- fixed values: open-data sets and the columns each field may come from -
OPEN_DATA_SETS = {
    "TX": dict(
        label="Texas Open Data",
        date=["start_date"],
        title=["project_name"],
        id=["po_contract_number"],
        agency=["vendor_name_description"],
        end_date=["end_date"],
        amount=["total_amount"],
    ),
    "NY": dict(
        label="New York Open Data",
        date=["award_date", "begin_date", "renewal_date"],
        title=["procurement_description", "type_of_procurement"],
        id=[],
        agency=["authority_name"],
        end_date=["fiscal_year_end_date"],
        amount=["contract_amount", "amount_expended_to_date"],
    ),
    "WA": dict(
        label="Washington Open Data",
        date=["contract_effective_start", "period_of_performance_start"],
        title=["purpose_of_the_contract", "procurement_type"],
        id=["agency_contract_no", "agency_contract_amendment"],
        agency=["agency_number_agency_name"],
        end_date=[],
        amount=["state_amount", "federal_amount", "other_amount"],
    ),
    "MD": dict(
        label="Maryland Open Data",
        date=[],
        title=["short_description"],
        id=["bid_number"],
        agency=["organization_name"],
        end_date=[],
        amount=[],
    ),
}

# --- fixed values: state portals, platform | state | source label | start page
PORTALS = [
    tuple(line.split("|"))
    for line in """
generic|CA|California Cal eProcure|https://caleprocure.ca.gov/pages/Events-BS3/event-search.aspx
generic|CT|Connecticut CTsource|https://biznet.ct.gov/SCP_Search/BidResults.aspx
generic|IN|Indiana IDOA|https://www.in.gov/idoa/procurement/current-business-opportunities/
generic|KS|Kansas Procurement|https://admin.ks.gov/offices/procurement-and-contracts/bid-solicitations
generic|MN|Minnesota Procurement|https://mn.gov/admin/government/procurement-contracting/open-solicitations/
generic|ND|North Dakota OMB|https://www.omb.nd.gov/doing-business-state/current-bid-opportunities
generic|TN|Tennessee Edison|https://tn.gov/generalservices/procurement/central-procurement-office--cpo-/opportunities.html
generic|WI|Wisconsin VendorNet|https://vendornet.wi.gov/Bids.aspx
generic|KY|Kentucky eProcurement|https://finance.ky.gov/eProcurement/Pages/default.aspx
generic|ME|Maine Purchases|https://www.maine.gov/dafs/bbm/procurementservices/vendors/current-bids
generic|MI|Michigan SIGMA|https://www.michigan.gov/dtmb/procurement/contractconnect
generic|WV|West Virginia Purchasing|https://www.state.wv.us/admin/purchase/Bids/default.html
generic|FL|Florida MFMP|https://vendor.myfloridamarketplace.com/search/bids/posted
generic|LA|Louisiana LaPAC|https://wwwcfprd.doa.louisiana.gov/osp/lapac/pubMain.cfm
generic|SC|South Carolina SCPRO|https://procurement.sc.gov/solicitations/current
generic|AL|Alabama Purchasing|https://procurement.alabama.gov/current-bid-opportunities/
generic|AZ|Arizona APP|https://app.az.gov/page.aspx/en/rfx/rfx_browse/open
generic|MD|Maryland eMMa|https://emma.maryland.gov/page.aspx/en/rfx/rfx_browse/open
generic|OH|Ohio OhioBuys|https://ohiobuys.ohio.gov/page.aspx/en/rfx/rfx_browse/open
generic|VT|Vermont Procurement|https://bgs.vermont.gov/purchasing/bids
generic|AK|Alaska DOT Procurement|https://dot.alaska.gov/procurement/awp/bids.html
generic|CO|Colorado OSC Solicitations|https://osc.colorado.gov/spco/solicitations
generic|HI|Hawaii SPO|https://hands.ehawaii.gov/hands/opportunities
generic|MS|Mississippi MAGIC|https://www.ms.gov/dfa/contract_bid_search
generic|MO|Missouri MissouriBUYS|https://missouribuys.mo.gov/search/publicSolicitation
generic|NE|Nebraska Materiel|https://das.nebraska.gov/materiel/bidopps.html
generic|NH|New Hampshire Procurement|https://das.nh.gov/purchasing/bidscontracts/bids.aspx
generic|NY|New York OGS Bids|https://ogs.ny.gov/procurement/bid-opportunities
generic|RI|Rhode Island Purchasing|https://purchasing.ri.gov/RIVIP/ExternalBids.aspx
generic|SD|South Dakota Procurement|https://www.sd.gov/bhra
generic|VA|Virginia eVA|https://mvendor.cgieva.com/Vendor/public/AllOpportunities/
generic|WA|Washington DES Contracts|https://apps.des.wa.gov/DESContracts/
generic|WY|Wyoming Procurement|https://ai.wyo.gov/divisions/general-services/procurement/bid-opportunities
generic|DE|Delaware MyMarketplace|https://mymarketplace.delaware.gov/bids
generic|ID|Idaho Purchasing|https://purchasing.idaho.gov/bid-opportunities/
generic|OK|Oklahoma OMES|https://oklahoma.gov/omes/services/purchasing/solicitations.html
buyspeed|AR|Arkansas ARBuy|https://arbuy.arkansas.gov/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
buyspeed|IL|Illinois BidBuy|https://www.bidbuy.illinois.gov/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
buyspeed|MA|Massachusetts COMMBUYS|https://www.commbuys.com/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
buyspeed|NV|Nevada NEVADAePro|https://nevadaepro.com/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
buyspeed|NJ|New Jersey NJSTART|https://www.njstart.gov/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
buyspeed|OR|Oregon OregonBuys|https://oregonbuys.gov/bso/view/search/external/advancedSearchBid.xhtml?openBids=true
jaggaer|GA|Georgia TGM|https://ssl.doas.state.ga.us/PRSapp/PR_index.jsp
jaggaer|IA|Iowa IMPACS|https://bids.sciquest.com/apps/Router/PublicEvent?CustomerOrg=DASIowa
jaggaer|MT|Montana eProcurement|https://solutions.sciquest.com/apps/Router/PublicEvent?CustomerOrg=StateOfMontana
jaggaer|NM|New Mexico eProNM|https://solutions.sciquest.com/apps/Router/PublicEvent?CustomerOrg=StateOfNewMexico
jaggaer|PA|Pennsylvania eMarketplace|https://www.emarketplace.state.pa.us/Solicitations.aspx
jaggaer|UT|Utah Procurement|https://solutions.sciquest.com/apps/Router/PublicEvent?CustomerOrg=StateOfUtah
""".strip().splitlines()
]
