"""What the oracle holds the site's fixed values to be, stated apart from the values the library uses."""

# Code of a city in result-page urls, by its slug.
CITIES = """
  ('hanoi', 'ha-noi-xc1'),
  ('ha-noi', 'ha-noi-xc1'),
  ('hà-nội', 'ha-noi-xc1'),
  ('ho-chi-minh', 'tp-hcm-xc79'),
  ('hochiminh', 'tp-hcm-xc79'),
  ('ho-chi-minh-city', 'tp-hcm-xc79'),
  ('sai-gon', 'tp-hcm-xc79'),
  ('saigon', 'tp-hcm-xc79'),
  ('tp-hcm', 'tp-hcm-xc79'),
  ('tphcm', 'tp-hcm-xc79'),
  ('da-nang', 'da-nang-xc48'),
  ('danang', 'da-nang-xc48'),
  ('đà-nẵng', 'da-nang-xc48'),
  ('hai-phong', 'hai-phong-xc31'),
  ('haiphong', 'hai-phong-xc31'),
  ('hải-phòng', 'hai-phong-xc31'),
  ('can-tho', 'can-tho-xc92'),
  ('cantho', 'can-tho-xc92'),
  ('cần-thơ', 'can-tho-xc92'),
  ('bac-giang', 'bac-giang-xc24'),
  ('bac-kan', 'bac-kan-xc6'),
  ('bắc-kạn', 'bac-kan-xc6'),
  ('bac-ninh', 'bac-ninh-xc27'),
  ('bắc-ninh', 'bac-ninh-xc27'),
  ('cao-bang', 'cao-bang-xc4'),
  ('dien-bien', 'dien-bien-xc11'),
  ('điện-biên', 'dien-bien-xc11'),
  ('gia-lam', 'gia-lam-xc8'),
  ('gia-lâm', 'gia-lam-xc8'),
  ('ha-giang', 'ha-giang-xc2'),
  ('hà-giang', 'ha-giang-xc2'),
  ('ha-nam', 'ha-nam-xc35'),
  ('hà-nam', 'ha-nam-xc35'),
  ('ha-tinh', 'ha-tinh-xc42'),
  ('hà-tĩnh', 'ha-tinh-xc42'),
  ('hung-yen', 'hung-yen-xc33'),
  ('hưng-yên', 'hung-yen-xc33'),
  ('lai-chau', 'lai-chau-xc12'),
  ('lai-châu', 'lai-chau-xc12'),
  ('lang-son', 'lang-son-xc20'),
  ('lạng-sơn', 'lang-son-xc20'),
  ('lao-cai', 'lao-cai-xc10'),
  ('lào-cai', 'lao-cai-xc10'),
  ('nam-dinh', 'nam-dinh-xc36'),
  ('nam-định', 'nam-dinh-xc36'),
  ('nghe-an', 'nghe-an-xc40'),
  ('nghệ-an', 'nghe-an-xc40'),
  ('ninh-binh', 'ninh-binh-xc37'),
  ('ninh-bình', 'ninh-binh-xc37'),
  ('phu-tho', 'phu-tho-xc25'),
  ('phú-thọ', 'phu-tho-xc25'),
  ('quang-ninh', 'quang-ninh-xc22'),
  ('quảng-ninh', 'quang-ninh-xc22'),
  ('son-la', 'son-la-xc14'),
  ('sơn-la', 'son-la-xc14'),
  ('thai-binh', 'thai-binh-xc34'),
  ('thái-bình', 'thai-binh-xc34'),
  ('thai-nguyen', 'thai-nguyen-xc19'),
  ('thái-nguyên', 'thai-nguyen-xc19'),
  ('thanh-hoa', 'thanh-hoa-xc38'),
  ('thanh-hóa', 'thanh-hoa-xc38'),
  ('tuyen-quang', 'tuyen-quang-xc8'),
  ('tuyên-quang', 'tuyen-quang-xc8'),
  ('vinh-phuc', 'vinh-phuc-xc26'),
  ('vĩnh-phúc', 'vinh-phuc-xc26'),
  ('yen-bai', 'yen-bai-xc15'),
  ('yên-bái', 'yen-bai-xc15'),
  ('binh-dinh', 'binh-dinh-xc52'),
  ('bình-định', 'binh-dinh-xc52'),
  ('binh-thuan', 'binh-thuan-xc60'),
  ('bình-thuận', 'binh-thuan-xc60'),
  ('dak-lak', 'dak-lak-xc66'),
  ('đắk-lắk', 'dak-lak-xc66'),
  ('dak-nong', 'dak-nong-xc67'),
  ('đắk-nông', 'dak-nong-xc67'),
  ('gia-lai', 'gia-lai-xc64'),
  ('khanh-hoa', 'khanh-hoa-xc56'),
  ('khánh-hòa', 'khanh-hoa-xc56'),
  ('kon-tum', 'kon-tum-xc62'),
  ('lam-dong', 'lam-dong-xc68'),
  ('lâm-đồng', 'lam-dong-xc68'),
  ('phu-yen', 'phu-yen-xc54'),
  ('phú-yên', 'phu-yen-xc54'),
  ('quang-binh', 'quang-binh-xc44'),
  ('quảng-bình', 'quang-binh-xc44'),
  ('quang-nam', 'quang-nam-xc49'),
  ('quảng-nam', 'quang-nam-xc49'),
  ('quang-ngai', 'quang-ngai-xc51'),
  ('quảng-ngãi', 'quang-ngai-xc51'),
  ('quang-tri', 'quang-tri-xc45'),
  ('quảng-trị', 'quang-tri-xc45'),
  ('thua-thien-hue', 'thua-thien-hue-xc46'),
  ('thừa-thiên-huế', 'thua-thien-hue-xc46'),
  ('an-giang', 'an-giang-xc89'),
  ('ba-ria-vung-tau', 'ba-ria-vung-tau-xc77'),
  ('bà-rịa-vũng-tàu', 'ba-ria-vung-tau-xc77'),
  ('bac-lieu', 'bac-lieu-xc95'),
  ('bạc-liêu', 'bac-lieu-xc95'),
  ('ben-tre', 'ben-tre-xc83'),
  ('bến-tre', 'ben-tre-xc83'),
  ('binh-duong', 'binh-duong-xc74'),
  ('bình-dương', 'binh-duong-xc74'),
  ('binh-phuoc', 'binh-phuoc-xc70'),
  ('bình-phước', 'binh-phuoc-xc70'),
  ('ca-mau', 'ca-mau-xc96'),
  ('cà-mau', 'ca-mau-xc96'),
  ('dong-nai', 'dong-nai-xc75'),
  ('đồng-nai', 'dong-nai-xc75'),
  ('dong-thap', 'dong-thap-xc87'),
  ('đồng-tháp', 'dong-thap-xc87'),
  ('hai-duong', 'hai-duong-xc30'),
  ('hải-dương', 'hai-duong-xc30'),
  ('hau-giang', 'hau-giang-xc93'),
  ('hậu-giang', 'hau-giang-xc93'),
  ('hoa-binh', 'hoa-binh-xc17'),
  ('hòa-bình', 'hoa-binh-xc17'),
  ('kien-giang', 'kien-giang-xc91'),
  ('kiên-giang', 'kien-giang-xc91'),
  ('long-an', 'long-an-xc80'),
  ('soc-trang', 'soc-trang-xc94'),
  ('sóc-trăng', 'soc-trang-xc94'),
  ('tay-ninh', 'tay-ninh-xc72'),
  ('tây-ninh', 'tay-ninh-xc72'),
  ('tien-giang', 'tien-giang-xc82'),
  ('tiền-giang', 'tien-giang-xc82'),
  ('tra-vinh', 'tra-vinh-xc84'),
  ('trà-vinh', 'tra-vinh-xc84'),
  ('vinh-long', 'vinh-long-xc86'),
  ('vĩnh-long', 'vinh-long-xc86')"""

# Category of a property type.
CATEGORIES = """
  ('can-ho-chung-cu', 'ci38'),
  ('nha-rieng', 'ci40'),
  ('nha-mat-pho', 'ci41'),
  ('dat-nen', 'ci42'),
  ('van-phong', 'ci43'),
  ('phong-tro', 'ci44'),
  ('real-estate', 'ci38'),
  ('house', 'ci40'),
  ('flat', 'ci38'),
  ('plot', 'ci42'),
  ('parking-space', 'ci45'),
  ('multi-family-residential', 'ci46'),
  ('office-commerce-industry', 'ci43'),
  ('agriculture', 'ci47'),
  ('other-objects', 'ci48')"""

# Url word of an action.
ACTIONS = """
  ('buy', 'mua-ban'),
  ('rent', 'cho-thue')"""

# How coordinates are written on a page, first found first.
COORDINATES = [
    r"place\?q=([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
    r"([-+]?\d{1,3}\.\d{4,}),\s*([-+]?\d{1,3}\.\d{4,})",
    r'"lat"\s*:\s*([-+]?\d*\.\d+).*?"lng"\s*:\s*([-+]?\d*\.\d+)',
    r"""latitude["']\s*:\s*["']?([-+]?\d*\.\d+)["']?.*?longitude["']\s*:\s*["']?([-+]?\d*\.\d+)["']?""",
    r"center=([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
    r"@([-+]?\d*\.\d+),([-+]?\d*\.\d+)",
]
