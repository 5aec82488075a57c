"""The three business domains as data: columns, types, feeds and cleaning rules.

Everything below is a set of fixed values: the delivered column names and the
canonical names and types are agreed with the feeds, so they are stated as they
are. A row has the canonical column, its type, whether it must not be NULL, and each
feed's column, None where a feed does not deliver it.
"""

from __future__ import annotations

from siltstone.specs import Default, DomainSpec, Feed, Range, SumOf

# Canonical column, type, not NULL, alpha feed column, beta feed column.
POSITIONS_COLUMNS = (
    ("position_id", "STRING", True, "POS_ID", "POSITION_KEY"),
    ("book_id", "STRING", True, "BOOK_CODE", "BOOK_ID"),
    ("as_of_date", "DATE", True, "BUS_DATE", "AS_OF_DT"),
    ("account_id", "STRING", False, "ACCT_ID", "ACCOUNT_NUM"),
    ("account_name", "STRING", False, "ACCT_NAME", "ACCOUNT_DESC"),
    ("account_type", "STRING", False, "ACCT_TYPE", "ACCT_CLASSIFICATION"),
    ("legal_entity_id", "STRING", False, "LE_ID", "LEGAL_ENTITY"),
    ("legal_entity_name", "STRING", False, "LE_NAME", "LE_DESC"),
    ("custodian_id", "STRING", False, "CUST_ID", "CUSTODIAN_CODE"),
    ("custodian_name", "STRING", False, "CUST_NAME", "CUSTODIAN_DESC"),
    ("prime_broker_id", "STRING", False, "PB_ID", "PRIME_BROKER"),
    ("prime_broker_name", "STRING", False, "PB_NAME", "PB_DESC"),
    ("security_id", "STRING", True, "SEC_ID", "SECURITY_KEY"),
    ("quantity", "DECIMAL(18,4)", False, "QTY", "UNITS_HELD"),
    ("notional_amount", "DECIMAL(18,2)", False, "NOTIONAL", "FACE_VALUE"),
    ("market_value_local", "DECIMAL(18,2)", False, "MV_LOCAL", "MKT_VAL_LC"),
    ("market_value_base", "DECIMAL(18,2)", False, "MV_BASE", "MKT_VAL_USD"),
    ("cost_basis", "DECIMAL(18,2)", False, "COST_BASIS", "ORIG_COST"),
    ("accrued_interest", "DECIMAL(18,2)", False, "ACCR_INT", "ACCRUED"),
    ("unrealized_pnl", "DECIMAL(18,2)", False, "UNREAL_PNL", "UNREALIZED_GL"),
    ("realized_pnl", "DECIMAL(18,2)", False, "REAL_PNL", "REALIZED_GL"),
    ("total_pnl", "DECIMAL(18,2)", False, "TOTAL_PNL", "TOTAL_GL"),
    ("daily_pnl", "DECIMAL(18,2)", False, "DAILY_PNL", "DAY_PNL"),
    ("mtd_pnl", "DECIMAL(18,2)", False, "MTD_PNL", "MTD_GL"),
    ("ytd_pnl", "DECIMAL(18,2)", False, "YTD_PNL", "YTD_GL"),
    ("trade_date", "DATE", False, "TRD_DATE", "TRADE_DT"),
    ("settle_date", "DATE", False, "SETTLE_DATE", "SETTLEMENT_DT"),
    ("effective_date", "DATE", False, "EFF_DATE", "EFFECTIVE_DT"),
    ("long_short_indicator", "STRING", False, "LS_IND", "LONG_SHORT"),
    ("position_type", "STRING", False, "POS_TYPE", "POSITION_CLASS"),
    ("position_status", "STRING", False, "POS_STATUS", "STATUS"),
    ("currency", "STRING", False, "CCY", "LOCAL_CCY"),
    ("base_currency", "STRING", False, "BASE_CCY", "RPT_CCY"),
    ("fx_rate_to_base", "DECIMAL(12,6)", False, "FX_RATE", "FX_RATE_USD"),
    ("desk", "STRING", False, "DESK_NAME", "TRADING_DESK"),
    ("desk_id", "STRING", False, "DESK_ID", "DESK_CODE"),
    ("strategy", "STRING", False, "STRAT_NAME", "STRATEGY_DESC"),
    ("strategy_id", "STRING", False, "STRAT_ID", "STRATEGY_CODE"),
    ("portfolio_id", "STRING", False, "PORT_ID", "PORTFOLIO_KEY"),
    ("portfolio_name", "STRING", False, "PORT_NAME", "PORTFOLIO_DESC"),
    ("fund_id", "STRING", False, "FUND_ID", "FUND_KEY"),
    ("fund_name", "STRING", False, "FUND_NAME", "FUND_DESC"),
    ("trader_id", "STRING", False, "TRADER_ID", "TRADER_CODE"),
    ("trader_name", "STRING", False, "TRADER_NAME", "TRADER_DESC"),
    ("counterparty_id", "STRING", False, "CP_ID", "CPTY_KEY"),
    ("counterparty_name", "STRING", False, "CP_NAME", "CPTY_DESC"),
    ("counterparty_lei", "STRING", False, "CP_LEI", "CPTY_LEI"),
    ("lot_id", "STRING", False, "LOT_ID", "TAX_LOT_KEY"),
    ("lot_date", "DATE", False, "LOT_DATE", "TAX_LOT_DT"),
    ("lot_cost", "DECIMAL(18,2)", False, "LOT_COST", "TAX_LOT_COST"),
    ("weight_in_portfolio", "DECIMAL(8,4)", False, "PORT_WEIGHT", "PORTFOLIO_PCT"),
    ("weight_in_fund", "DECIMAL(8,4)", False, "FUND_WEIGHT", "FUND_PCT"),
    ("margin_requirement", "DECIMAL(18,2)", False, "MARGIN_REQ", "MARGIN_AMT"),
    ("collateral_value", "DECIMAL(18,2)", False, "COLLATERAL_VAL", "COLL_VALUE"),
    ("haircut_pct", "DECIMAL(8,4)", False, "HAIRCUT", "HAIRCUT_PCT"),
    ("financing_rate", "DECIMAL(8,6)", False, "FIN_RATE", "FINANCING_RT"),
    ("financing_cost", "DECIMAL(18,2)", False, "FIN_COST", "FINANCING_AMT"),
    ("source_system", "STRING", True, None, None),
    ("source_record_id", "STRING", False, "RECORD_ID", "SRC_REC_ID"),
    ("source_load_timestamp", "TIMESTAMP", False, "LOAD_TS", "LOAD_TIMESTAMP"),
    ("created_timestamp", "TIMESTAMP", False, None, None),
    ("updated_timestamp", "TIMESTAMP", False, None, None),
    ("is_active", "BOOLEAN", False, "IS_ACTIVE", "ACTIVE_FLAG"),
    ("regulatory_book", "STRING", False, "REG_BOOK", "REG_CLASSIFICATION"),
    ("accounting_treatment", "STRING", False, "ACCT_TREATMENT", "ACCT_METHOD"),
)

# Canonical column, type, not NULL, security master column.
SECURITY_COLUMNS = (
    ("security_id", "STRING", True, "SEC_ID"),
    ("isin", "STRING", False, "ISIN_CODE"),
    ("cusip", "STRING", False, "CUSIP_NUM"),
    ("sedol", "STRING", False, "SEDOL_NUM"),
    ("ticker", "STRING", False, "TICKER"),
    ("bbg_global_id", "STRING", False, "BBG_GLOBAL_ID"),
    ("ric", "STRING", False, "RIC_CODE"),
    ("figi", "STRING", False, "FIGI_CODE"),
    ("security_name", "STRING", False, "SEC_NAME"),
    ("security_short_name", "STRING", False, "SEC_SHORT_NAME"),
    ("security_description", "STRING", False, "SEC_DESC"),
    ("security_type", "STRING", False, "SEC_TYPE"),
    ("asset_class", "STRING", False, "ASSET_CLASS"),
    ("sub_asset_class", "STRING", False, "SUB_ASSET_CLASS"),
    ("product_type", "STRING", False, "PRODUCT_TYPE"),
    ("issuer_id", "STRING", False, "ISSUER_ID"),
    ("issuer_name", "STRING", False, "ISSUER_NAME"),
    ("issuer_short_name", "STRING", False, "ISSUER_SHORT"),
    ("issuer_lei", "STRING", False, "ISSUER_LEI"),
    ("issuer_country", "STRING", False, "ISSUER_COUNTRY"),
    ("issuer_domicile", "STRING", False, "ISSUER_DOMICILE"),
    ("issuer_sector", "STRING", False, "ISSUER_SECTOR"),
    ("coupon_rate", "DECIMAL(8,5)", False, "CPN_RATE"),
    ("coupon_frequency", "STRING", False, "CPN_FREQ"),
    ("coupon_type", "STRING", False, "CPN_TYPE"),
    ("coupon_currency", "STRING", False, "CPN_CCY"),
    ("day_count_convention", "STRING", False, "DAY_COUNT"),
    ("accrual_start_date", "DATE", False, "ACCR_START_DT"),
    ("first_coupon_date", "DATE", False, "FIRST_CPN_DT"),
    ("last_coupon_date", "DATE", False, "LAST_CPN_DT"),
    ("next_coupon_date", "DATE", False, "NEXT_CPN_DT"),
    ("maturity_date", "DATE", False, "MATURITY_DT"),
    ("issue_date", "DATE", False, "ISSUE_DT"),
    ("dated_date", "DATE", False, "DATED_DT"),
    ("first_settle_date", "DATE", False, "FIRST_SETTLE_DT"),
    ("worst_call_date", "DATE", False, "WORST_CALL_DT"),
    ("worst_put_date", "DATE", False, "WORST_PUT_DT"),
    ("next_call_date", "DATE", False, "NEXT_CALL_DT"),
    ("next_put_date", "DATE", False, "NEXT_PUT_DT"),
    ("first_call_date", "DATE", False, "FIRST_CALL_DT"),
    ("first_put_date", "DATE", False, "FIRST_PUT_DT"),
    ("call_price", "DECIMAL(12,6)", False, "CALL_PRICE"),
    ("put_price", "DECIMAL(12,6)", False, "PUT_PRICE"),
    ("call_type", "STRING", False, "CALL_TYPE"),
    ("is_callable", "BOOLEAN", False, "IS_CALLABLE"),
    ("is_puttable", "BOOLEAN", False, "IS_PUTTABLE"),
    ("is_convertible", "BOOLEAN", False, "IS_CONVERTIBLE"),
    ("is_perpetual", "BOOLEAN", False, "IS_PERPETUAL"),
    ("is_144a", "BOOLEAN", False, "IS_144A"),
    ("is_reg_s", "BOOLEAN", False, "IS_REG_S"),
    ("par_value", "DECIMAL(18,2)", False, "PAR_VALUE"),
    ("minimum_denomination", "DECIMAL(18,2)", False, "MIN_DENOM"),
    ("minimum_increment", "DECIMAL(18,2)", False, "MIN_INCR"),
    ("issue_size", "DECIMAL(18,2)", False, "ISSUE_SIZE"),
    ("amount_outstanding", "DECIMAL(18,2)", False, "AMT_OUTSTANDING"),
    ("currency", "STRING", False, "CCY"),
    ("country_of_risk", "STRING", False, "CTRY_RISK"),
    ("country_of_domicile", "STRING", False, "CTRY_DOMICILE"),
    ("country_of_incorporation", "STRING", False, "CTRY_INCORP"),
    ("region", "STRING", False, "REGION"),
    ("sector", "STRING", False, "SECTOR"),
    ("industry_group", "STRING", False, "IND_GROUP"),
    ("industry", "STRING", False, "INDUSTRY"),
    ("sub_industry", "STRING", False, "SUB_INDUSTRY"),
    ("credit_rating_sp", "STRING", False, "RATING_SP"),
    ("credit_rating_moody", "STRING", False, "RATING_MOODY"),
    ("credit_rating_fitch", "STRING", False, "RATING_FITCH"),
    ("composite_rating", "STRING", False, "RATING_COMPOSITE"),
    ("rating_outlook_sp", "STRING", False, "OUTLOOK_SP"),
    ("rating_outlook_moody", "STRING", False, "OUTLOOK_MOODY"),
    ("seniority", "STRING", False, "SENIORITY"),
    ("collateral_type", "STRING", False, "COLLATERAL_TYPE"),
    ("guarantee_type", "STRING", False, "GUARANTEE_TYPE"),
    ("payment_rank", "STRING", False, "PAYMENT_RANK"),
    ("benchmark_index", "STRING", False, "BENCHMARK_IDX"),
    ("spread_to_benchmark", "DECIMAL(8,4)", False, "SPREAD_BM"),
    ("float_index", "STRING", False, "FLOAT_IDX"),
    ("float_spread", "DECIMAL(8,4)", False, "FLOAT_SPREAD"),
    ("float_reset_frequency", "STRING", False, "FLOAT_RESET_FREQ"),
    ("exchange", "STRING", False, "EXCHANGE"),
    ("listing_status", "STRING", False, "LISTING_STATUS"),
    ("trading_status", "STRING", False, "TRADING_STATUS"),
    ("settlement_type", "STRING", False, "SETTLE_TYPE"),
    ("tax_status", "STRING", False, "TAX_STATUS"),
    ("created_timestamp", "TIMESTAMP", False, "CREATED_TS"),
)

# Canonical column, type, not NULL, risk engine column.
RISK_COLUMNS = (
    ("risk_calc_id", "STRING", True, "CALC_ID"),
    ("security_id", "STRING", True, "SEC_ID"),
    ("position_id", "STRING", True, "POS_ID"),
    ("as_of_date", "DATE", True, "CALC_DATE"),
    ("calc_timestamp", "TIMESTAMP", False, "CALC_TS"),
    ("price_clean", "DECIMAL(12,6)", False, "CLEAN_PX"),
    ("price_dirty", "DECIMAL(12,6)", False, "DIRTY_PX"),
    ("price_mid", "DECIMAL(12,6)", False, "MID_PX"),
    ("price_bid", "DECIMAL(12,6)", False, "BID_PX"),
    ("price_ask", "DECIMAL(12,6)", False, "ASK_PX"),
    ("price_source", "STRING", False, "PX_SOURCE"),
    ("yield_to_maturity", "DECIMAL(8,5)", False, "YTM"),
    ("yield_to_worst", "DECIMAL(8,5)", False, "YTW"),
    ("yield_to_call", "DECIMAL(8,5)", False, "YTC"),
    ("current_yield", "DECIMAL(8,5)", False, "CUR_YIELD"),
    ("yield_spread_to_govt", "DECIMAL(8,4)", False, "SPREAD_GOVT"),
    ("duration_macaulay", "DECIMAL(10,6)", False, "DUR_MAC"),
    ("duration_modified", "DECIMAL(10,6)", False, "DUR_MOD"),
    ("duration_effective", "DECIMAL(10,6)", False, "DUR_EFF"),
    ("duration_spread", "DECIMAL(10,6)", False, "DUR_SPREAD"),
    ("duration_key_rate_2y", "DECIMAL(10,6)", False, "KRD_2Y"),
    ("duration_key_rate_5y", "DECIMAL(10,6)", False, "KRD_5Y"),
    ("duration_key_rate_10y", "DECIMAL(10,6)", False, "KRD_10Y"),
    ("duration_key_rate_30y", "DECIMAL(10,6)", False, "KRD_30Y"),
    ("convexity", "DECIMAL(10,6)", False, "CONVEXITY"),
    ("effective_convexity", "DECIMAL(10,6)", False, "EFF_CONVEXITY"),
    ("dv01", "DECIMAL(18,2)", False, "DV01"),
    ("cr01", "DECIMAL(18,2)", False, "CR01"),
    ("cs01", "DECIMAL(18,2)", False, "CS01"),
    ("oas", "DECIMAL(8,4)", False, "OAS"),
    ("z_spread", "DECIMAL(8,4)", False, "Z_SPREAD"),
    ("i_spread", "DECIMAL(8,4)", False, "I_SPREAD"),
    ("g_spread", "DECIMAL(8,4)", False, "G_SPREAD"),
    ("asset_swap_spread", "DECIMAL(8,4)", False, "ASW_SPREAD"),
    ("var_95_1d", "DECIMAL(18,2)", False, "VAR_95_1D"),
    ("var_99_1d", "DECIMAL(18,2)", False, "VAR_99_1D"),
    ("var_95_10d", "DECIMAL(18,2)", False, "VAR_95_10D"),
    ("cvar_95_1d", "DECIMAL(18,2)", False, "CVAR_95_1D"),
    ("cvar_99_1d", "DECIMAL(18,2)", False, "CVAR_99_1D"),
    ("beta_to_benchmark", "DECIMAL(8,4)", False, "BETA"),
    ("tracking_error", "DECIMAL(8,4)", False, "TRACK_ERR"),
    ("delta", "DECIMAL(10,6)", False, "DELTA"),
    ("gamma", "DECIMAL(10,6)", False, "GAMMA"),
    ("theta", "DECIMAL(10,6)", False, "THETA"),
    ("vega", "DECIMAL(10,6)", False, "VEGA"),
    ("rho", "DECIMAL(10,6)", False, "RHO"),
    ("scenario_up_50bps", "DECIMAL(18,2)", False, "SCEN_UP_50"),
    ("scenario_down_50bps", "DECIMAL(18,2)", False, "SCEN_DN_50"),
    ("scenario_up_100bps", "DECIMAL(18,2)", False, "SCEN_UP_100"),
    ("scenario_down_100bps", "DECIMAL(18,2)", False, "SCEN_DN_100"),
    ("scenario_up_200bps", "DECIMAL(18,2)", False, "SCEN_UP_200"),
    ("scenario_credit_widen_100bps", "DECIMAL(18,2)", False, "SCEN_CRD_100"),
    ("implied_volatility", "DECIMAL(8,4)", False, "IMPL_VOL"),
    ("historical_volatility_30d", "DECIMAL(8,4)", False, "HIST_VOL_30D"),
    ("liquidity_score", "DECIMAL(5,2)", False, "LIQ_SCORE"),
)

POSITIONS = DomainSpec(
    name="positions",
    key=("position_id", "book_id", "as_of_date"),
    columns=tuple((name, kind) for name, kind, *_ in POSITIONS_COLUMNS),
    required=tuple(row[0] for row in POSITIONS_COLUMNS if row[2]),
    feeds=(
        Feed("accounting_system_alpha", {row[3]: row[0] for row in POSITIONS_COLUMNS if row[3]}),
        Feed("accounting_system_beta", {row[4]: row[0] for row in POSITIONS_COLUMNS if row[4]}),
    ),
    source_column="source_system",
    upper_trim=(
        "long_short_indicator", "position_type", "position_status", "account_type",
        "base_currency", "currency", "regulatory_book", "accounting_treatment",
    ),
    defaults=(Default("position_status", ("OPEN", "CLOSED", "PENDING"), "OPEN"),),
    sums=(SumOf("total_pnl", ("unrealized_pnl", "realized_pnl")),),
    stamps=("created_timestamp", "updated_timestamp"),
    partition="as_of_date",
    rejects="quarantine",
)

SECURITY = DomainSpec(
    name="security",
    key=("security_id",),
    columns=tuple((name, kind) for name, kind, *_ in SECURITY_COLUMNS),
    required=tuple(row[0] for row in SECURITY_COLUMNS if row[2]),
    feeds=(Feed("security_master", {row[3]: row[0] for row in SECURITY_COLUMNS if row[3]}),),
    upper_trim=(
        "security_type", "asset_class", "sub_asset_class", "product_type", "coupon_frequency",
        "coupon_type", "call_type", "seniority", "trading_status", "tax_status",
        "credit_rating_sp", "credit_rating_moody", "credit_rating_fitch", "composite_rating",
    ),
    ranges=(Range("coupon_rate", 0, 100),),
    rejects="quarantine",
    absent="close",  # declared as a full refresh: every delivery is the whole master
)

RISK_ANALYTICS = DomainSpec(
    name="risk_analytics",
    key=("risk_calc_id",),
    columns=tuple((name, kind) for name, kind, *_ in RISK_COLUMNS),
    required=tuple(row[0] for row in RISK_COLUMNS if row[2]),
    feeds=(Feed("risk_engine", {row[3]: row[0] for row in RISK_COLUMNS if row[3]}),),
    upper_trim=("price_source",),
    ranges=(
        Range("yield_to_maturity", -50, 200),
        Range("yield_to_worst", -50, 200),
        Range("yield_to_call", -50, 200),
        Range("current_yield", -50, 200),
        Range("liquidity_score", 0, 100),
    ),
    partition="as_of_date",
    rejects="quarantine",
)

DOMAINS = {spec.name: spec for spec in (POSITIONS, SECURITY, RISK_ANALYTICS)}

# What each dimension adds to the wide table, and on which key.
WIDE_TABLE = "enterprise_positions"
WIDE_JOINS = (
    ("security", ("security_id",), "left"),
    ("risk_analytics", ("position_id", "as_of_date"), "left"),
)
# Columns of a dimension that the wide table leaves out besides the join keys.
WIDE_EXCLUDED = {"risk_analytics": ("security_id",)}
