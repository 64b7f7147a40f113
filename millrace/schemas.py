"""Record layouts shared by sources, parsers and tests, as Spark DDL strings."""

# The layouts that existing files and messages have.
CAR = (
    "Name string, Miles_per_Gallon double, Cylinders long, Displacement double, "
    "Horsepower long, Weight_in_lbs long, Acceleration double, Year string, Origin string"
)
STOCK = "company string, date date, value double"
PERSON = (
    "id int, firstName string, middleName string, lastName string, gender string, "
    "birthDate date, ssn string, salary int"
)
BAND = "id long, name string, hometown string, year long"
GUITAR_PLAYER = "id long, name string, guitars array<long>, band long"
SOCIAL_POST = "postType string, count int, storageUsed int"
COLOUR_EVENT = "created long, color string"
CLICK = "sessionId string, clickDuration long"
LINE = "value string"
