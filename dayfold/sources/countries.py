"""The built-in country dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dayfold.schema import DIMENSION_SCHEMA
from dayfold.sources.tables import dedup_dimension

# Fixed values, in declared order: name, iso code, latitude, longitude,
# population. One name is declared twice.
COUNTRIES = [
    ("India", "IND", 20.5937, 78.9629, 1_417_173_173),
    ("China", "CHN", 35.8617, 104.1954, 1_425_887_337),
    ("United States", "USA", 37.0902, -95.7129, 339_996_563),
    ("Indonesia", "IDN", -0.7893, 113.9213, 277_534_122),
    ("Pakistan", "PAK", 30.3753, 69.3451, 240_485_658),
    ("Brazil", "BRA", -14.2350, -51.9253, 215_454_994),
    ("Nigeria", "NGA", 9.0820, 8.6753, 223_000_000),
    ("Bangladesh", "BGD", 23.6850, 90.3563, 170_993_755),
    ("Russia", "RUS", 61.5240, 105.3188, 144_713_314),
    ("Mexico", "MEX", 23.6345, -102.5528, 128_455_507),
    ("Japan", "JPN", 36.2048, 138.2529, 123_294_513),
    ("Ethiopia", "ETH", 9.1450, 40.4897, 120_283_026),
    ("Philippines", "PHL", 12.8797, 121.7740, 119_106_242),
    ("Egypt", "EGY", 26.8206, 30.8025, 110_887_041),
    ("Vietnam", "VNM", 14.0583, 108.2772, 97_328_541),
    ("Democratic Republic of the Congo", "COD", -4.0383, 21.7587, 99_010_212),
    ("Turkey", "TUR", 38.9637, 35.2433, 85_326_000),
    ("Iran", "IRN", 32.4279, 53.6880, 90_550_570),
    ("Germany", "DEU", 51.1657, 10.4515, 83_368_221),
    ("Thailand", "THA", 15.8700, 100.9925, 71_800_000),
    ("United Kingdom", "GBR", 55.3781, -3.4360, 67_736_802),
    ("Tanzania", "TZA", -6.3690, 34.8888, 60_142_438),
    ("France", "FRA", 46.2276, 2.2137, 68_014_000),
    ("South Africa", "ZAF", -30.5595, 22.9375, 60_142_191),
    ("Italy", "ITA", 41.8719, 12.5674, 59_110_627),
    ("Kenya", "KEN", -0.0236, 37.9062, 54_037_487),
    ("Myanmar", "MMR", 21.9162, 95.9560, 54_409_800),
    ("Colombia", "COL", 4.5709, -74.2973, 51_874_024),
    ("Sudan", "SDN", 12.8628, 30.8025, 45_657_202),
    ("Ukraine", "UKR", 48.3794, 31.1656, 38_000_000),
    ("Canada", "CAN", 56.1304, -106.3468, 39_674_209),
    ("Algeria", "DZA", 28.0339, 1.6596, 44_615_272),
    ("Argentina", "ARG", -38.4161, -63.6167, 46_044_703),
    ("Iraq", "IRQ", 33.2232, 43.6793, 44_496_122),
    ("Afghanistan", "AFG", 33.9391, 67.7100, 42_235_775),
    ("Morocco", "MAR", 31.7917, -7.0926, 37_344_795),
    ("Saudi Arabia", "SAU", 23.8859, 45.0792, 36_408_820),
    ("Uzbekistan", "UZB", 41.3775, 64.5853, 35_163_944),
    ("Angola", "AGO", -11.2027, 17.8739, 32_866_268),
    ("Peru", "PER", -9.1900, -75.0152, 34_354_719),
    ("Malaysia", "MYS", 4.2105, 101.6964, 34_002_200),
    ("Ghana", "GHA", 7.3697, -5.7418, 34_121_985),
    ("Yemen", "YEM", 15.5527, 48.5164, 34_628_603),
    ("Nepal", "NPL", 28.3949, 84.1240, 30_547_580),
    ("Venezuela", "VEN", 6.4238, -66.5897, 28_436_426),
    ("Madagascar", "MDG", -18.7669, 46.8691, 28_915_653),
    ("Cameroon", "CMR", 3.8480, 11.5021, 28_249_251),
    ("Ivory Coast", "CIV", 7.5400, -5.5471, 27_654_529),
    ("North Korea", "PRK", 40.3399, 127.5101, 26_160_821),
    ("Senegal", "SEN", 14.4974, -14.4524, 17_316_449),
    ("Somalia", "SOM", 5.1521, 46.1996, 18_143_378),
    ("Zimbabwe", "ZWE", -19.0154, 29.1549, 16_665_409),
    ("Sri Lanka", "LKA", 7.8731, 80.7718, 21_497_310),
    ("Mali", "MLI", 17.5707, -3.9962, 22_405_178),
    ("Burkina Faso", "BFA", 12.2383, -1.5616, 22_673_762),
    ("Syria", "SYR", 34.8021, 38.9968, 18_269_868),
    ("Malawi", "MWI", -13.2543, 34.3015, 20_195_619),
    ("Chile", "CHL", -35.6751, -71.5430, 19_838_061),
    ("Australia", "AUS", -25.2744, 133.7751, 26_465_917),
    ("Kazakhstan", "KAZ", 48.0196, 66.9237, 20_406_862),
    ("Ecuador", "ECU", -1.8312, -78.1834, 18_190_484),
    ("Zambia", "ZMB", -13.1339, 27.8493, 20_216_417),
    ("Senegal", "SEN", 14.4974, -14.4524, 17_316_449),
    ("Guatemala", "GTM", 15.7835, -90.2308, 18_054_816),
    ("Guinea", "GIN", 9.9456, -9.6966, 13_665_541),
    ("South Korea", "KOR", 35.9078, 127.7669, 51_780_579),
    ("Spain", "ESP", 40.4637, -3.7492, 47_615_034),
    ("Belgium", "BEL", 50.5039, 4.4699, 11_590_324),
    ("Greece", "GRC", 39.0742, 21.8243, 10_533_984),
    ("Portugal", "PRT", 39.3999, -8.2245, 10_532_564),
    ("Sweden", "SWE", 60.1282, 18.6435, 10_593_151),
    ("Hong Kong", "HKG", 22.3193, 114.1694, 7_512_000),
    ("Austria", "AUT", 47.5162, 14.5501, 9_121_023),
    ("Israel", "ISR", 31.0461, 34.8516, 9_038_309),
    ("Serbia", "SRB", 44.0165, 21.0059, 6_552_000),
    ("Bulgaria", "BGR", 42.7339, 25.4858, 6_839_000),
    ("Cuba", "CUB", 21.5218, -77.7812, 10_987_317),
    ("Dominican Republic", "DOM", 18.7357, -70.1627, 11_056_884),
    ("Czech Republic", "CZE", 49.8175, 15.4730, 10_510_785),
    ("Haiti", "HTI", 18.9712, -72.2852, 11_263_077),
    ("New Zealand", "NZL", -40.9006, 174.8860, 5_188_000),
    ("Norway", "NOR", 60.4720, 8.4689, 5_490_374),
    ("Costa Rica", "CRI", 9.7489, -83.7534, 5_334_052),
    ("Ireland", "IRL", 53.4129, -8.2439, 5_263_277),
    ("Singapore", "SGP", 1.3521, 103.8198, 5_916_100),
]


def country_entries(spark: SparkSession) -> DataFrame:
    """The declared entries as they stand, numbered by position."""
    rows = [(ordinal, *entry) for ordinal, entry in enumerate(COUNTRIES)]
    return spark.createDataFrame(rows, DIMENSION_SCHEMA)


def country_dimension(spark: SparkSession) -> DataFrame:
    """One row per country."""
    return dedup_dimension(country_entries(spark))
