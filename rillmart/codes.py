"""Business codes found in change records.

Fixed values: they are data written by the upstream shop and must match it.
"""

ORDER_UNPAID = "1001"
ORDER_PAID = "1002"
ORDER_CANCELLED = "1003"
ORDER_FINISHED = "1004"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"

PAY_ALIPAY = "1101"
PAY_WECHAT = "1102"
PAY_UNION = "1103"

APPRAISE_GOOD = "1201"
APPRAISE_SOSO = "1202"
APPRAISE_BAD = "1203"
APPRAISE_AUTO = "1204"

REASON_BAD_GOODS = "1301"
REASON_WRONG_DESC = "1302"
REASON_SOLD_OUT = "1303"
REASON_SIZE = "1304"
REASON_MISTAKE = "1305"
REASON_NONE = "1306"
REASON_OTHER = "1307"

COUPON_UNUSED = "1401"
COUPON_USING = "1402"
COUPON_USED = "1403"

REFUND_MONEY_ONLY = "1501"
REFUND_WITH_GOODS = "1502"

PAYMENT_SUCCESS = "1602"
REFUND_SUCCESS = "0705"

SOURCE_QUERY = "2401"
SOURCE_PROMOTION = "2402"
SOURCE_RECOMMEND = "2403"
SOURCE_ACTIVITY = "2404"

ACTIVITY_RULE_FULL_REDUCTION = "3101"
ACTIVITY_RULE_FULL_DISCOUNT = "3102"
ACTIVITY_RULE_DISCOUNT = "3103"

COUPON_TYPE_FULL_REDUCTION = "3201"
COUPON_TYPE_FULL_DISCOUNT = "3202"
COUPON_TYPE_VOUCHER = "3203"

COUPON_RANGE_CATEGORY3 = "3301"
COUPON_RANGE_TRADEMARK = "3302"
COUPON_RANGE_SPU = "3303"

KEYWORD_SEARCH = "SEARCH"
KEYWORD_CLICK = "CLICK"
KEYWORD_CART = "CART"
KEYWORD_ORDER = "ORDER"

#: snapshot markers that carry no row
BOOTSTRAP_MARKERS = ("bootstrap-start", "bootstrap-complete")
