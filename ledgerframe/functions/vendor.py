"""Vendor column headers -> schema names (A4), for landed files that keep the
vendor's own headers. ``cleaning.rename_columns`` applies a mapping to the headers
present, so already-renamed files pass through unchanged."""

# The market-data vendor's headers as delivered.

DIVIDEND_HEADERS = {
    "代码": "symbol",
    "名称": "name",
    "送转股份-送转总比例": "total_bonus_split",
    "送转股份-送转比例": "bonus_share",
    "送转股份-转股比例": "split_share",
    "现金分红-现金分红比例": "cash_dividend",
    "现金分红-股息率": "dividend_yield",
    "每股收益": "eps",
    "每股净资产": "bps",
    "每股公积金": "capital_reserve",
    "每股未分配利润": "undistributed_profit",
    "净利润同比增长": "net_profit_growth",
    "总股本": "total_shares",
    "预案公告日": "proposal_date",
    "股权登记日": "record_date",
    "除权除息日": "ex_dividend_date",
    "方案进度": "progress",
    "最新公告日期": "latest_announcement",
}

SHARE_CAPITAL_HEADERS = {
    "数据日期": "data_date",
    "当日收盘价": "close",
    "当日涨跌幅": "change_pct",
    "总市值": "total_mv",
    "流通市值": "circulating_mv",
    "总股本": "total_share",
    "流通股本": "float_share",
    "PE(TTM)": "pe_ttm",
    "PE(静)": "pe_static",
    "市净率": "pb",
    "PEG值": "peg",
    "市现率": "pcf",
    "市销率": "ps",
}

CODE_LIST_HEADERS = {"代码": "code"}

DAILY_BAR_HEADERS = {"date": "trade_date"}

SECTOR_MAPPING_HEADERS = {
    "行业代码": "industry_code",
    "一级行业名称": "level1",
    "二级行业名称": "level2",
    "三级行业名称": "level3",
}

INDEX_COLUMNS = ["trade_date", "index_value", "pb", "pb_weighted", "pb_median"]   # by position
