"""Record schemas of the warehouse, layer by layer."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, L, TS = T.StringType(), T.LongType(), T.TimestampType()

DAU_INFO = _record(mid=S, uid=S, ar=S, ch=S, vc=S, dt=S, hr=S, mi=S, ts=L)

# As it arrives in ODS_ORDER_INFO; the attributes derived later are in ORDER_INFO_DWD.
ORDER_INFO = _record(
    id=L, province_id=L, order_status=S, user_id=L, final_total_amount=MONEY,
    benefit_reduce_amount=MONEY, original_total_amount=MONEY, feight_fee=MONEY,
    expire_time=S, create_time=S, operate_time=S,
)

ORDER_INFO_DWD = T.StructType(ORDER_INFO.fields + _record(
    create_date=S, create_hour=S, if_first_order=S,
    province_name=S, province_area_code=S, province_3166_2_code=S,
    user_age_group=S, user_gender=S,
).fields)

ORDER_DETAIL = _record(
    id=L, order_id=L, sku_id=L, order_price=MONEY, sku_num=L, sku_name=S, create_time=S,
    spu_id=L, tm_id=L, category3_id=L, spu_name=S, tm_name=S, category3_name=S,
)

ORDER_WIDE = _record(
    order_detail_id=L, order_id=L, order_status=S, create_time=S, user_id=L,
    sku_id=L, sku_price=MONEY, sku_num=L, sku_name=S,
    benefit_reduce_amount=MONEY, original_total_amount=MONEY, feight_fee=MONEY,
    final_total_amount=MONEY, final_detail_amount=MONEY,
    if_first_order=S, province_name=S, province_area_code=S,
    user_age_group=S, user_gender=S, dt=S,
    spu_id=L, tm_id=L, category3_id=L, spu_name=S, tm_name=S, category3_name=S,
)

PROVINCE = _record(id=S, name=S, area_code=S, iso_code=S, iso_3166_2=S)
USER_STATE = _record(user_id=S, if_consumed=S)
USER_INFO = _record(id=L, name=S, gender=S, birthday=S)
SKU_INFO = _record(id=L, spu_id=L, tm_id=L, category3_id=L)
SPU_INFO = _record(id=L, spu_name=S)
TRADEMARK = _record(id=L, tm_name=S)
CATEGORY3 = _record(id=L, name=S)
SEARCH_DOC = _record(id=S, name=S)

MESSAGE = _record(topic=S, key=S, value=S)
