"""The labelled table that the random field is trained on: contacts in spellings that fixed patterns miss.

Fixed values. Every line is one row; marked is what counts as personal data, all else does not.
"""

LABELLED = """
write to <email>anna.berg (at) mail.example.com</email> before noon
contact <email>j.doe [at] example [dot] org</email> for the files
mail me: <email>peter at example dot com</email> or come by
questions go to <email>info@ example.com</email> please
reach <email>sales.team(at)shop(dot)example(dot)net</email> today
the address <email>k_lopez42 at mail7 dot example dot com</email> still works
<email>support [at] example.org</email> answers at night
write <email>maria77 (at) example (dot) fr</email> and wait
send it to <email>team9@mail .example.com</email> at once
call <phone>(702) 555-0742</phone> after lunch
phone <phone>702-555-0173</phone> or write
my number is <phone>702 555 0199</phone> at home
tel. <phone>(0351) 555 0142</phone> in the office
call us at <phone>702.555.0111</phone> any day
fax <phone>0221 555 01234</phone> and phone
ring <phone>(415) 555 0100</phone> between nine and five
the phone number <phone>(030) 555-01234</phone> is new
text <phone>617-555-0188</phone> now
mobile <phone>0171 555 0166</phone> only
card <card>4417.1234.5678.9113</card> was charged
card number <card>4012  8888  8888  1881</card> is blocked
paid with <card>5105_1051_0510_5100</card> last week
visa <card>4111/1111/1111/1111</card> expired
the credit card <card>3782.822463.10005</card> was lost
server <ip>97[.]51[.]17[.]173</ip> is down
login from <ip>10(.)0(.)12(.)7</ip> failed
host <ip>192[.]168[.]4[.]20</ip> answered
requests from <ip>161 . 17 . 88 . 162</ip> were refused
address <ip>83[dot]229[dot]25[dot]121</ip> is ours
the year 1998 was warm and 2004 was not
version 2.0 of the license from 2011
licensed under CC BY-NC 4.0 in 2019
under the Apache License, Version 2.0. See there
the GNU General Public License, version 3. It says
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" in the file
key 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b was printed
he paid 1,250.00 for 12 of them on 2021-03-04
it costs $ 45.99 at the shop
page 12 of 340 and lines 7-19
at 10:45 on 12.05.2020 we left
the score was 3-2 after 90 minutes
about 3.5 million people in 1999-2003
chapter 4.2.1 shows 15 % of 2000
order 9807915762804490 was sent
the id 4845168114407329 is not known
room 702 on floor 5 at 8 in the evening
ISBN 978-3-16-148410-0 is out of print
table 2 lists 512 x 1024 pixels
see rfc 2822 and rfc 5322 for details
meet at the station at 9
we met at noon and at 12 again
look at the dot at 3 o'clock
the dot at the end of line 7
plain words that mean nothing at all
from 100 to 200 and back to 150 555
numbers 12 345 6789 in a row 10 11 12
the and of 34@mail7.example.com is found elsewhere
the +1 (017) 555-7713 is found elsewhere
thnt 97.51.17.173 is found elsewhere
and 4417744280351547 is found elsewhere
<email>anna at example.com</email>
write to <email>anna at example.com</email> before noon
please mail <email>j.meyer at mail.example.org</email> today
you can reach <email>peter at shop.example.net</email> for the files
my address is <email>k_lopez at example . com</email> since May
send it to <email>maria at example. org</email> at once
contact <email>tom at example . net</email>
he stayed at home. Then he left
they looked at it. She said no
we were at school. It was late
see the page at www.example.com for more
more of it is found at example.org and elsewhere
look at setup.py in the folder
""".strip().split("\n")
