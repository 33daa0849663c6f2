"""These must be exactly as they are for results to agree."""

# Fixed value: the text that marks a returned order line.
RETURN_MARKER = "○"

# Header names of the sales file and the column names they become.
SALES_COLUMN_NAMES = {
    "オーダー ID": "order_id",
    "行 ID": "row_id",
    "オーダー日": "order_date",
    "出荷日": "ship_date",
    "出荷モード": "ship_mode",
    "顧客 ID": "customer_id",
    "顧客名": "customer_name",
    "顧客区分": "customer_segment",
    "市区町村": "city",
    "都道府県": "prefecture",
    "国/領域": "country_region",
    "地域": "region",
    "地域マネージャー": "region_manager",
    "製品 ID": "product_id",
    "カテゴリ": "category",
    "サブカテゴリ": "sub_category",
    "製品名": "product_name",
    "売上": "sales_amount",
    "数量": "quantity",
    "割引率": "discount_rate",
    "利益": "profit",
    "緯度": "latitude",
    "経度": "longitude",
    "予算": "budget",
    "返品": "returned",
}
SALES_COLUMNS = list(SALES_COLUMN_NAMES.values())

# Names of the four totals.
KPI_SALES = "売上合計"
KPI_PROFIT = "利益合計"
KPI_ORDERS = "オーダー数"
KPI_CUSTOMERS = "顧客数"

# Performance tags.
TAG_EXCELLENT = "優秀"
TAG_STANDARD = "標準"
TAG_NEEDS_ATTENTION = "要改善"

# Age groups and the ages below which they end.
AGE_YOUNG = "若年層"
AGE_MIDDLE = "中年層"
AGE_SENIOR = "シニア層"
AGE_YOUNG_BELOW = 35
AGE_MIDDLE_BELOW = 55

# Product categories counted apart.
CATEGORY_FOOD = "食料品"
CATEGORY_DAILY = "日用品"

# Quality rules on transactions.
TRANSACTION_RULES = {
    "quantity_is_more_than_1": "quantity >= 1",
    "transaction_price_is_more_than_0": "transaction_price > 0",
}

# Labels of the generated star schema, in order of id modulo their number.
PRODUCT_LINES = ["Electronics", "Grocery", "Apparel", "Home", "Toys"]
AD_TYPES = ["TV", "Web", "Flyer", "SNS"]
COUPON_TYPES = ["Percent", "Fixed", "BOGO"]
PRICE_REDUCTION_TYPES = ["Discount", "Bundle"]
CITIES = ["新宿区", "大阪市", "名古屋市", "札幌市", "福岡市", "仙台市", "横浜市", "広島市", "京都市", "神戸市"]
PREFECTURES = ["東京都", "大阪府", "愛知県", "北海道", "福岡県", "宮城県", "神奈川県", "広島県", "京都府", "兵庫県"]

# Seeds of the hashed foreign keys and amounts, and the domain of each.
FACT_HASH_SEEDS = {"customer_id": 31, "product_id": 37, "time_id": 41, "promotion_id": 43, "revenue": 47, "units_sold": 53}
N_PRODUCTS, N_DAYS, N_PROMOTIONS = 10_000, 1_826, 100
FIRST_DAY = "2021-01-01"

# Masking.
MASKED_SALARY = -99.99
VISIBLE_REGION = "APAC"
TAG_KEY = "my_tags"

# Categorical columns of the churn table that become 0/1 columns.
CHURN_CATEGORIES = [
    "gender", "partner", "dependents", "phoneService", "multipleLines", "internetService",
    "onlineSecurity", "onlineBackup", "deviceProtection", "techSupport", "streamingTV",
    "streamingMovies", "contract", "paperlessBilling", "paymentMethod",
]
CHURN_NUMBERS = ["seniorCitizen", "tenure", "monthlyCharges", "totalCharges"]

# Review categories.
REVIEW_LABELS = ["品揃え・在庫", "品質", "コスパ・お得感", "接客・サービス", "店舗設備・環境", "その他"]

# Wording of the three review prompts.
REVIEW_HEADING = "[顧客レビュー]"
RULES_HEADING = "[厳守事項]"
CLASSIFY_TASK = "[指示]次の顧客レビュー内容を、次のカテゴリのいずれかに分類してください"
CLASSIFY_HEADING = "[分類カテゴリ]"
CLASSIFY_RULES = ["カテゴリから1つのみ選択してください。", "カテゴリのみ出力してください。補足は一切不要です。"]
SUMMARIZE_TASK = "[指示]次の顧客レビューから要点を絞って、明快で簡潔な一つの文章に要約して下さい"
SUMMARIZE_RULES = ["要約結果のみ出力してください。こちらの指示に関する補足は一切不要です。", "30文字以内に収めること。"]
SCORE_TASK = "[指示]次の顧客レビュー内容について、0~1の間でポジティブスコアを付与してください"
SCORE_HEADING = "[出力形式]"
SCORE_FORMAT = ["範囲0~1の少数第二位までで出力してください。", "1に近いほどポジティブ度合いが強く、0に近いほどポジティブ度合いが弱い。"]
SCORE_RULES = ["ポジティブスコアのみ出力してください。補足は一切不要です。"]

# Sales metrics: display name, comment, synonyms. Fixed values.
METRIC_TEXTS = {
    "order_month": ("オーダー月", "オーダー月（月次集計用）", ()),
    "category": ("カテゴリ", "カテゴリ（家具/電化製品/オフィス用品）", ()),
    "sub_category": ("サブカテゴリ", "サブカテゴリ", ()),
    "region": ("地域", "地域（関東/関西/中部/九州）", ()),
    "prefecture": ("都道府県", "都道府県", ()),
    "customer_segment": ("顧客区分", "顧客区分（消費者/企業/小規模オフィス）", ()),
    "total_sales": ("売上合計", "売上合計", ("売上", "総売上")),
    "total_profit": ("利益合計", "利益合計", ("利益", "総利益")),
    "total_quantity": ("販売数量", "販売数量", ("数量", "売上個数")),
    "order_count": ("オーダー数", "オーダー数", ("注文数", "オーダー件数")),
    "customer_count": ("顧客数", "顧客数", ("ユニーク顧客数",)),
    "profit_margin": ("利益率", "利益率（利益÷売上）", ("マージン",)),
    "avg_order_value": ("平均オーダー単価", "平均オーダー単価", ()),
}
