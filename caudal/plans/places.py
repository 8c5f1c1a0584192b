"""Coordinates of countries, Mexican states and Argentine provinces, for map output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.operators.joins import attach_places

# Country name, latitude, longitude.
COUNTRIES = (
    ("Mexico", 23.0, -102.0),
    ("Argentina", -34.0, -64.0),
    ("Brazil", -10.0, -55.0),
    ("Chile", -30.0, -71.0),
    ("Peru", -9.0, -75.0),
    ("Colombia", 4.0, -74.0),
    ("Ecuador", -1.5, -78.0),
    ("Bolivia (Plurinational State of)", -16.5, -64.9),
    ("Paraguay", -23.0, -58.0),
    ("Uruguay", -32.5, -56.0),
    ("Venezuela (Bolivarian Republic of)", 7.0, -66.0),
    ("Guatemala", 15.5, -90.25),
    ("Honduras", 15.0, -86.5),
    ("El Salvador", 13.8, -88.9),
    ("Nicaragua", 12.8, -85.0),
    ("Costa Rica", 10.0, -84.0),
    ("Panama", 8.5, -80.0),
    ("Belize", 17.25, -88.77),
    ("Cuba", 21.5, -80.0),
    ("Haiti", 19.0, -72.5),
    ("Dominican Republic", 19.0, -70.7),
    ("Guyana", 5.0, -59.0),
    ("Suriname", 4.0, -56.0),
    ("Trinidad and Tobago", 10.69, -61.22),
    ("Antigua and Barbuda", 17.05, -61.8),
    ("Dominica", 15.4, -61.3),
    ("Jamaica", 18.1, -77.3),
    ("Saint Lucia", 13.9, -60.97),
    ("Turks and Caicos Islands", 21.75, -71.58),
    ("Falkland Islands (Malvinas)", -51.8, -59.0),
    ("Saint Martin (French Part)", 18.07, -63.08),
    ("Cayman Islands", 19.31, -81.25),
    ("Saint Barthélemy", 17.9, -62.83),
)

# Country name, province name, latitude, longitude.
PROVINCES = (
    ("Mexico", "Aguascalientes", 21.88, -102.30),
    ("Mexico", "Baja California", 30.84, -115.28),
    ("Mexico", "Baja California Sur", 25.65, -111.99),
    ("Mexico", "Campeche", 19.00, -90.50),
    ("Mexico", "Chiapas", 16.50, -93.00),
    ("Mexico", "Chihuahua", 28.50, -106.00),
    ("Mexico", "Ciudad de México", 19.43, -99.13),
    ("Mexico", "Coahuila", 27.30, -101.00),
    ("Mexico", "Colima", 19.10, -103.85),
    ("Mexico", "Durango", 24.00, -104.60),
    ("Mexico", "Guanajuato", 21.00, -101.25),
    ("Mexico", "Guerrero", 17.50, -99.50),
    ("Mexico", "Hidalgo", 20.50, -98.90),
    ("Mexico", "Jalisco", 20.70, -103.30),
    ("Mexico", "México", 19.30, -99.60),
    ("Mexico", "Michoacán", 19.50, -101.50),
    ("Mexico", "Morelos", 18.77, -99.10),
    ("Mexico", "Nayarit", 21.70, -105.20),
    ("Mexico", "Nuevo León", 25.50, -99.80),
    ("Mexico", "Oaxaca", 17.00, -96.50),
    ("Mexico", "Puebla", 19.00, -98.20),
    ("Mexico", "Querétaro", 20.80, -99.90),
    ("Mexico", "Quintana Roo", 19.60, -88.30),
    ("Mexico", "San Luis Potosí", 22.00, -100.90),
    ("Mexico", "Sinaloa", 24.00, -107.50),
    ("Mexico", "Sonora", 29.00, -110.00),
    ("Mexico", "Tabasco", 17.80, -92.60),
    ("Mexico", "Tamaulipas", 24.00, -98.50),
    ("Mexico", "Tlaxcala", 19.40, -98.20),
    ("Mexico", "Veracruz", 19.00, -96.50),
    ("Mexico", "Yucatán", 20.70, -89.00),
    ("Mexico", "Zacatecas", 23.00, -102.50),
    ("Argentina", "Buenos Aires", -36.50, -60.00),
    ("Argentina", "Catamarca", -27.20, -66.30),
    ("Argentina", "Chaco", -26.50, -60.60),
    ("Argentina", "Chubut", -43.50, -68.50),
    ("Argentina", "Córdoba", -31.40, -64.20),
    ("Argentina", "Corrientes", -28.70, -58.80),
    ("Argentina", "Entre Ríos", -32.00, -59.00),
    ("Argentina", "Formosa", -26.20, -58.20),
    ("Argentina", "Jujuy", -23.20, -65.30),
    ("Argentina", "La Pampa", -37.00, -65.00),
    ("Argentina", "La Rioja", -29.40, -67.00),
    ("Argentina", "Mendoza", -34.60, -68.30),
    ("Argentina", "Misiones", -27.30, -55.90),
    ("Argentina", "Neuquén", -38.90, -70.10),
    ("Argentina", "Río Negro", -40.80, -67.80),
    ("Argentina", "Salta", -24.80, -65.40),
    ("Argentina", "San Juan", -30.90, -68.80),
    ("Argentina", "San Luis", -33.30, -66.40),
    ("Argentina", "Santa Cruz", -48.80, -69.00),
    ("Argentina", "Santa Fe", -31.50, -60.70),
    ("Argentina", "Santiago del Estero", -27.80, -64.30),
    ("Argentina", "Tierra del Fuego", -54.80, -68.30),
    ("Argentina", "Tucumán", -26.90, -65.20),
)


def countries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(COUNTRIES), "country_name string, lat double, lon double")


def provinces(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROVINCES), "country_name string, province_name string, lat double, lon double")


def on_country_map(df: DataFrame) -> DataFrame:
    """Rows of countries with known coordinates."""
    return attach_places(df, countries(df.sparkSession), "country_name")


def on_province_map(df: DataFrame) -> DataFrame:
    """Rows of provinces with known coordinates."""
    placed = attach_places(df, provinces(df.sparkSession), ["country_name", "province_name"], drop_unknown=False)
    return placed.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
