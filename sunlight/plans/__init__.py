from sunlight.plans.columns import DeclarationColumns, PrescriptionColumns, RAW, RX
from sunlight.plans.declarations import (stg_declarations, clean_specialities, declarations_geo,
                                         payment_report, top_companies, top_professions,
                                         top_motives, speciality_summary, raw_departments,
                                         recipient_regions)
from sunlight.plans.catalogue import (product_bridge, lab_dim, lab_top_products, catalogue_top,
                                      load_catalogue)
from sunlight.plans.prescriptions import (prescriptions_raw, prescriptions_mart, sales_mart,
                                          prescription_checks, distinct_counts,
                                          top_products_by_boxes, region_top, sales_check,
                                          distinct_sketches, merge_sketches, SKETCH_ERROR)
from sunlight.plans.influence import (lab_name_map, influence_spend, influence_fact,
                                      influence_groups, groups_preview, top_roi, company_focus,
                                      sales_by_company_region, INFLUENCE_MOTIVES)
from sunlight.plans.recipients import (geo_ref, recipients, recipients_geo, recipient_totals,
                                       with_catalogue_names)
from sunlight.plans.search import (search_recipients, search_declarations, search_recipients_batch,
                                   landing_stats, landing_labels, payer_labels, recipient_report)
from sunlight.plans.search_index import build_search_index, look_up, search_index
from sunlight.plans.marts import Marts, build_marts
